"""US federal holiday calendar (C1) and the calendar features.

The calendar is built by rule inside Spark: one row per (year, rule), then
``make_date`` / ``next_day`` resolve fixed and n-th-weekday holidays, and the
weekend observance days are added as extra rows. It is tiny (about a dozen
rows per year), so joins against it are broadcast hash joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.time import col_, hour_of_week, is_weekend, weekday0

# US federal holidays as (name, month, rule, since_year).
# rule "day:D" = fixed day D of the month, observed Sat->Fri and Sun->Mon;
# "nth:N:DOW" = N-th weekday DOW of the month; "last:DOW" = last one.
US_FEDERAL_RULES = [
    ("New Year's Day", 1, "day:1", 1871),
    ("Martin Luther King Jr. Day", 1, "nth:3:MON", 1986),
    ("Washington's Birthday", 2, "nth:3:MON", 1971),
    ("Memorial Day", 5, "last:MON", 1971),
    ("Juneteenth National Independence Day", 6, "day:19", 2021),
    ("Independence Day", 7, "day:4", 1871),
    ("Labor Day", 9, "nth:1:MON", 1894),
    ("Columbus Day", 10, "nth:2:MON", 1971),
    ("Veterans Day", 11, "day:11", 1938),
    ("Thanksgiving", 11, "nth:4:THU", 1942),
    ("Christmas Day", 12, "day:25", 1871),
]


def _rule_date(year: Column, month: int, rule: str) -> Column:
    kind, *args = rule.split(":")
    first = F.make_date(year, F.lit(month), F.lit(1))
    if kind == "day":
        return F.make_date(year, F.lit(month), F.lit(int(args[0])))
    if kind == "nth":
        n, dow = int(args[0]), args[1]
        # next_day is strictly after, so start from the day before the 1st.
        return F.date_add(F.next_day(F.date_sub(first, 1), dow), 7 * (n - 1))
    if kind == "last":
        last = F.last_day(first)
        return F.date_sub(F.next_day(last, args[0]), 7)
    raise ValueError(rule)


def holidays_for_years(years: DataFrame, observed: bool = True, year_col: str = "year") -> DataFrame:
    """US federal holidays of the years in ``years`` (one row per year):
    ``holiday_date, name``. Observed days are extra rows named
    ``"<name> (observed)"``.

    Each year row is expanded by generators -- one row per rule, then the
    observed day where the rule moves it -- so the calendar is one narrow
    stage with no join or union.
    """
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(m).alias("m"), F.lit(r).alias("rule"),
                               F.lit(since).alias("since"))
                      for n, m, r, since in US_FEDERAL_RULES])
    y = years.select(F.col(year_col).cast("int").alias("year")).select("year", F.inline(rules))
    y = y.where(F.col("year") >= F.col("since"))
    d = None
    for _, month, rule, _ in US_FEDERAL_RULES:
        expr = _rule_date(F.col("year"), month, rule)
        cond = (F.col("m") == month) & (F.col("rule") == rule)
        d = F.when(cond, expr) if d is None else d.when(cond, expr)
    cal = y.select(d.alias("holiday_date"), "name", "rule")
    if not observed:
        return cal.select("holiday_date", "name")
    wd = F.weekday("holiday_date")
    moved = F.when(wd == 5, F.date_sub("holiday_date", 1)).otherwise(F.date_add("holiday_date", 1))
    obs = F.struct(moved.alias("holiday_date"), F.concat(F.col("name"), F.lit(" (observed)")).alias("name"))
    own = F.struct(F.col("holiday_date"), F.col("name"))
    both = F.when(F.col("rule").startswith("day:") & (wd >= 5), F.array(own, obs)).otherwise(F.array(own))
    return cal.select(F.inline(both))


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int,
                     observed: bool = True) -> DataFrame:
    """US federal holidays of ``first_year..last_year``.

    Callers that need a whole data range should pass one year either side
    (trap T20): the observed New Year's Day of year Y+1 can fall on
    31 December of year Y, and the eve of 31 December needs year Y+1.
    """
    years = spark.range(first_year, last_year + 1, numPartitions=1).withColumnRenamed("id", "year")
    return holidays_for_years(years, observed)


def holiday_calendar_for(df: DataFrame, time_col: str, observed: bool = True) -> DataFrame:
    """C1 for the years a table covers, one year either side (T20); the
    year list is derived in Spark from the data, one small aggregate."""
    bounds = df.agg((F.min(F.year(time_col)) - 1).alias("y0"), (F.max(F.year(time_col)) + 1).alias("y1"))
    years = bounds.select(F.explode(F.sequence("y0", "y1")).alias("year"))
    return holidays_for_years(years, observed)


def temporal_features(df: DataFrame, time_col: str = "pickup_datetime") -> DataFrame:
    """The six calendar features of C2 in one projection."""
    t = col_(time_col)
    return df.select(
        "*",
        F.hour(t).alias("hour"),
        weekday0(t).alias("day_of_week"),
        F.dayofmonth(t).alias("day_of_month"),
        F.month(t).alias("month"),
        is_weekend(t).alias("is_weekend"),
        hour_of_week(t).alias("hour_of_week"),
    )


def holiday_flags(calendar: DataFrame) -> DataFrame:
    """Per date: ``is_holiday`` and ``is_holiday_eve`` (the next day is a
    holiday), one row per date -- a few dozen rows per year."""
    h = calendar.select(F.col("holiday_date").alias("flag_date"), F.lit(1).alias("h"), F.lit(0).alias("e"))
    e = calendar.select(F.date_sub("holiday_date", 1).alias("flag_date"), F.lit(0).alias("h"), F.lit(1).alias("e"))
    return (h.unionByName(e).groupBy("flag_date")
             .agg(F.max("h").alias("is_holiday"), F.max("e").alias("is_holiday_eve")))


def with_holidays(df: DataFrame, calendar: DataFrame, time_col: str = "pickup_datetime") -> DataFrame:
    """Add ``is_holiday`` and ``is_holiday_eve`` (J6) with one broadcast
    hash join on the date. The flag table is bounded by the calendar's year
    range (about two dozen rows per year), not by the data."""
    flags = F.broadcast(holiday_flags(calendar))
    out = df.join(flags, F.to_date(col_(time_col)) == F.col("flag_date"), "left")
    return (out.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
               .withColumn("is_holiday_eve", F.coalesce("is_holiday_eve", F.lit(0)))
               .drop("flag_date"))
