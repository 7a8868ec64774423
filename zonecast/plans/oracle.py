"""DuckDB SQL for each registered query (the correctness oracle).

The SQL restates each operator independently of the Spark code, over the
pre-registered parquet views. A chain of common table expressions mirrors
the fixture pipeline; DuckDB only evaluates the ones a query references.
Doubles are rounded to 6 places, integers are BIGINT, dates are strings.
"""

from __future__ import annotations

import re

from zonecast.functions import normal
from zonecast.operators.diagnostics import LARGE_MEAN, LARGE_SD, OUTERMOST, SECOND
from zonecast.schema import FEATURES

# The time range and the dates derived from it, by the data.
T0, T1, CUT, FROM = (f"(SELECT {c} FROM rng)" for c in ("t0", "t1", "cut", "fs"))

CTES = [
    ("rng", """
SELECT CAST(date_trunc('day', min(ts)) AS TIMESTAMP) AS t0, CAST(date_trunc('hour', max(ts)) AS TIMESTAMP) AS t1,
       CAST(date_trunc('day', max(ts)) AS TIMESTAMP) - INTERVAL 8 DAY AS cut,
       CAST(date_trunc('day', max(ts)) AS TIMESTAMP) - INTERVAL 1 DAY AS fs FROM events"""),
    ("trips", """
SELECT event_id AS trip_id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id % 300 END AS pu_zone,
       event_id * 7 % 300 AS do_zone,
       ts AS pickup_ts,
       ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS dropoff_ts,
       value - 1.0 AS fare,
       CAST(json_extract_string(props, '$.k') AS BIGINT) / 10.0 AS distance,
       CAST(CASE WHEN event_id % 50 = 0 THEN NULL
                 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 END AS DOUBLE) AS passengers,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 2 + 1 END AS vendor_id,
       CASE WHEN event_type IN ('view', 'click') THEN 'fhvhv' ELSE 'yellow' END AS dataset,
       strftime(ts, '%Y-%m') AS year_month
FROM events"""),
    ("clean", """
SELECT *, date_diff('microsecond', pickup_ts, dropoff_ts) / 60000000.0 AS trip_duration_min
FROM trips
WHERE fare > 0 AND distance > 0 AND passengers > 0
  AND pu_zone BETWEEN 1 AND 265 AND do_zone BETWEEN 1 AND 265
  AND date_diff('microsecond', pickup_ts, dropoff_ts) / 60000000.0 >= 1"""),
    ("zh_src", """
SELECT dataset, pu_zone AS PULocationID, date_trunc('hour', pickup_ts) AS pickup_datetime,
       count(vendor_id) AS trip_count,
       round_even(avg(fare), 2) AS avg_fare,
       round_even(avg(distance), 2) AS avg_trip_distance,
       round_even(avg(passengers), 2) AS avg_passenger_count
FROM clean
GROUP BY dataset, pu_zone, date_trunc('hour', pickup_ts)"""),
    ("zh", """
SELECT PULocationID, pickup_datetime, CAST(sum(trip_count) AS BIGINT) AS trip_count,
       avg(avg_fare) AS avg_fare, avg(avg_trip_distance) AS avg_trip_distance,
       avg(avg_passenger_count) AS avg_passenger_count
FROM zh_src
GROUP BY PULocationID, pickup_datetime"""),
    ("hours", """
SELECT unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS pickup_datetime FROM rng"""),
    ("grid", """
SELECT z.PULocationID, h.pickup_datetime
FROM (SELECT DISTINCT PULocationID FROM zh) z, hours h"""),
    ("panel_full", """
SELECT g.PULocationID, g.pickup_datetime,
       CASE WHEN zh.PULocationID IS NULL THEN 0 ELSE zh.trip_count END AS trip_count,
       CASE WHEN zh.PULocationID IS NULL THEN 0.0 ELSE zh.avg_fare END AS avg_fare,
       CASE WHEN zh.PULocationID IS NULL THEN 0.0 ELSE zh.avg_trip_distance END AS avg_trip_distance,
       CASE WHEN zh.PULocationID IS NULL THEN 0.0 ELSE zh.avg_passenger_count END AS avg_passenger_count
FROM grid g LEFT JOIN zh USING (PULocationID, pickup_datetime)"""),
    ("panel", "SELECT PULocationID, pickup_datetime, trip_count FROM panel_full"),
    ("cal_rules", """
SELECT * FROM (VALUES
  ('New Year''s Day', 1, 'day', 1, 0, 1871),
  ('Martin Luther King Jr. Day', 1, 'nth', 3, 1, 1986),
  ('Washington''s Birthday', 2, 'nth', 3, 1, 1971),
  ('Memorial Day', 5, 'last', 0, 1, 1971),
  ('Juneteenth National Independence Day', 6, 'day', 19, 0, 2021),
  ('Independence Day', 7, 'day', 4, 0, 1871),
  ('Labor Day', 9, 'nth', 1, 1, 1894),
  ('Columbus Day', 10, 'nth', 2, 1, 1971),
  ('Veterans Day', 11, 'day', 11, 0, 1938),
  ('Thanksgiving', 11, 'nth', 4, 4, 1942),
  ('Christmas Day', 12, 'day', 25, 0, 1871)
) r(name, m, kind, n, dow, since)"""),
    ("cal_years", """
SELECT unnest(generate_series(min(year(ts)) - 1, max(year(ts)) + 1)) AS y FROM events"""),
    ("cal_base", """
SELECT name, kind,
  CASE kind
    WHEN 'day' THEN make_date(y, m, n)
    WHEN 'nth' THEN make_date(y, m, 1)
                    + CAST((dow - isodow(make_date(y, m, 1)) + 7) % 7 + 7 * (n - 1) AS INTEGER)
    ELSE last_day(make_date(y, m, 1))
         - CAST((isodow(last_day(make_date(y, m, 1))) - dow + 7) % 7 AS INTEGER)
  END AS holiday_date
FROM cal_years, cal_rules WHERE y >= since"""),
    ("cal", """
SELECT holiday_date, name FROM cal_base
UNION ALL
SELECT CASE WHEN isodow(holiday_date) = 6 THEN holiday_date - 1 ELSE holiday_date + 1 END,
       name || ' (observed)'
FROM cal_base WHERE kind = 'day' AND isodow(holiday_date) >= 6"""),
    ("feat", """
SELECT p.*,
  hour(pickup_datetime) AS hour,
  isodow(pickup_datetime) - 1 AS day_of_week,
  day(pickup_datetime) AS day_of_month,
  month(pickup_datetime) AS month,
  CAST(isodow(pickup_datetime) >= 6 AS BIGINT) AS is_weekend,
  (isodow(pickup_datetime) - 1) * 24 + hour(pickup_datetime) AS hour_of_week,
  CAST(CAST(pickup_datetime AS DATE) IN (SELECT holiday_date FROM cal) AS BIGINT) AS is_holiday,
  CAST(CAST(pickup_datetime AS DATE) + 1 IN (SELECT holiday_date FROM cal) AS BIGINT) AS is_holiday_eve,
  lag(CAST(trip_count AS DOUBLE), 1) OVER w AS lag_1h,
  lag(CAST(trip_count AS DOUBLE), 2) OVER w AS lag_2h,
  lag(CAST(trip_count AS DOUBLE), 3) OVER w AS lag_3h,
  lag(CAST(trip_count AS DOUBLE), 24) OVER w AS lag_24h,
  lag(CAST(trip_count AS DOUBLE), 168) OVER w AS lag_168h,
  avg(trip_count) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_mean_3h,
  avg(trip_count) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS rolling_mean_12h,
  avg(trip_count) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_mean_24h,
  avg(trip_count) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS rolling_mean_168h
FROM panel_full p
WINDOW w AS (PARTITION BY PULocationID ORDER BY pickup_datetime)"""),
]


def _cte_name(cte: str) -> str:
    return cte.split(" ")[0]


def _with(select: str) -> str:
    """The WITH clause of the tables that a query reads, directly or not."""
    wanted, kept = select, []
    for n, body in reversed(CTES):
        if re.search(rf"\b{_cte_name(n)}\b", wanted):
            kept.append(f"{n if ' AS ' in n else n + ' AS'} ({body.strip()})")
            wanted += body
    return ("WITH RECURSIVE " if any(k.startswith("descent ") for k in kept) else "WITH ") + ",\n".join(reversed(kept)) + "\n" if kept else ""


def q(select: str) -> str:
    """A query over the shared chain of tables."""
    return _with(select) + select.strip()


ORACLE: dict[str, str] = {}



def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


ORACLE["zone_hour_features"] = q(f"""
SELECT PULocationID, pickup_datetime, trip_count,
  {r6('avg_fare', 'avg_trip_distance', 'avg_passenger_count')},
  hour, day_of_week, day_of_month, month, is_weekend, hour_of_week, is_holiday, is_holiday_eve,
  {r6('lag_1h', 'lag_2h', 'lag_3h', 'lag_24h', 'lag_168h',
      'rolling_mean_3h', 'rolling_mean_12h', 'rolling_mean_24h', 'rolling_mean_168h')}
FROM feat""")
ORACLE["chunked_features"] = ORACLE["zone_hour_features"]

ORACLE["clean_trips"] = q(f"""
SELECT trip_id, pu_zone, do_zone, pickup_ts, dropoff_ts, {r6('fare', 'distance', 'passengers')},
       vendor_id, dataset, year_month, {r6('trip_duration_min')}
FROM clean""")

ORACLE["clean_report"] = q("""
SELECT count(*) AS rows_before,
       count(*) - (SELECT count(*) FROM clean) AS rows_removed,
       round(CASE WHEN count(*) > 0 THEN 100.0 * (count(*) - (SELECT count(*) FROM clean)) / count(*) END, 6)
         AS pct_removed,
       (SELECT count(*) FROM clean) AS rows_after
FROM trips""")

ORACLE["zone_hour_demand"] = q("""
SELECT pu_zone AS PULocationID, date_trunc('hour', pickup_ts) AS pickup_datetime,
       count(vendor_id) AS trip_count,
       round(round_even(avg(fare), 2), 6) AS avg_fare,
       round(round_even(avg(distance), 2), 6) AS avg_trip_distance,
       round(round_even(avg(passengers), 2), 6) AS avg_passenger_count
FROM clean GROUP BY 1, 2""")

_NORM = """
norm AS (
  SELECT pickup_ts AS pickup_datetime, pu_zone AS PULocationID, distance AS trip_distance,
         passengers AS passenger_count, 'yellow' AS dataset FROM trips WHERE dataset = 'yellow'
  UNION ALL
  SELECT pickup_ts, pu_zone, 0.0, 1.0, 'fhvhv' FROM trips WHERE dataset = 'fhvhv'),
src_tot AS (
  SELECT date_trunc('hour', pickup_datetime) AS pickup_datetime, PULocationID, dataset,
         coalesce(sum(trip_distance), 0.0) AS total_distance,
         coalesce(sum(passenger_count), 0.0) AS total_passengers,
         count(*) AS trip_count
  FROM norm WHERE PULocationID IS NOT NULL AND pickup_datetime IS NOT NULL
  GROUP BY 1, 2, 3)
"""


def q_norm(select: str) -> str:
    return _with(_NORM + select).rstrip("\n") + ",\n" + _NORM.strip() + "\n" + select.strip()


ORACLE["zone_hour_totals"] = q_norm(f"""
SELECT pickup_datetime, PULocationID, dataset, {r6('total_distance', 'total_passengers')}, trip_count
FROM src_tot""")

ORACLE["combined_demand"] = q_norm("""
SELECT pickup_datetime, PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count,
       round(sum(total_distance), 6) AS total_distance,
       round(sum(total_passengers), 6) AS total_passengers
FROM src_tot GROUP BY 1, 2""")

ORACLE["streaming_combined_demand"] = ORACLE["combined_demand"]

ORACLE["consolidated_demand"] = q(f"""
SELECT PULocationID, pickup_datetime, CAST(sum(trip_count) AS BIGINT) AS trip_count,
       round(avg(avg_fare), 6) AS avg_fare, round(avg(avg_trip_distance), 6) AS avg_trip_distance,
       round(avg(avg_passenger_count), 6) AS avg_passenger_count
FROM zh_src GROUP BY 1, 2""")

ORACLE["zone_hour_grid"] = q(f"""
SELECT PULocationID, pickup_datetime, trip_count,
       {r6('avg_fare', 'avg_trip_distance', 'avg_passenger_count')}
FROM panel_full""")

ORACLE["temporal_features"] = q("""
SELECT PULocationID, pickup_datetime, trip_count, hour, day_of_week, day_of_month, month,
       is_weekend, hour_of_week FROM feat""")

ORACLE["holiday_calendar"] = q("SELECT strftime(holiday_date, '%Y-%m-%d') AS holiday_date, name FROM cal")

ORACLE["holiday_flags"] = q("""
SELECT PULocationID, pickup_datetime, trip_count, is_holiday, is_holiday_eve FROM feat""")

ORACLE["lag_features"] = q(f"""
SELECT PULocationID, pickup_datetime, trip_count,
       {r6('lag_1h', 'lag_2h', 'lag_3h', 'lag_24h', 'lag_168h')} FROM feat""")

ORACLE["rolling_features"] = q(f"""
SELECT PULocationID, pickup_datetime, trip_count,
       {r6('rolling_mean_3h', 'rolling_mean_12h', 'rolling_mean_24h', 'rolling_mean_168h')} FROM feat""")

ORACLE["rolling_features_leakfree"] = q("""
SELECT PULocationID, pickup_datetime, trip_count,
  round(avg(trip_count) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_3h,
  round(avg(trip_count) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_12h,
  round(avg(trip_count) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_24h,
  round(avg(trip_count) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_168h
FROM panel WINDOW w AS (PARTITION BY PULocationID ORDER BY pickup_datetime)""")


# ---- shared CTEs for the evaluation side --------------------------------------
CTES += [
    ("pred0", """
SELECT f.*, coalesce(avg(trip_count) OVER (PARTITION BY PULocationID ORDER BY pickup_datetime
                                           ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0.0) AS y_pred
FROM feat f"""),
    ("pred", f"""
SELECT *, trip_count - y_pred AS error, abs(trip_count - y_pred) AS abs_error,
       CASE WHEN pickup_datetime < {CUT} THEN 'train' ELSE 'test' END AS period
FROM pred0"""),
    ("test", "SELECT * FROM pred WHERE period = 'test'"),
    ("busy", """
SELECT PULocationID FROM panel GROUP BY PULocationID
ORDER BY sum(trip_count) DESC, PULocationID LIMIT 5"""),
    ("zones_dim", """
SELECT s.s_suppkey AS LocationID, n.n_name AS Borough, s.s_name AS Zone, r.r_name AS service_zone
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    ("targets", """
SELECT z.PULocationID, s.step, r.fs + to_hours(s.step) AS ts
FROM (SELECT DISTINCT PULocationID FROM panel) z, rng r,
     (SELECT CAST(unnest(generate_series(0, 23)) AS BIGINT) AS step) s"""),
    ("hist", """
SELECT PULocationID, pickup_datetime, trip_count FROM panel
WHERE pickup_datetime >= (SELECT max(pickup_datetime) FROM panel) - INTERVAL 14 DAY"""),
    ("lagx", """
SELECT t.PULocationID, t.ts, k.k, t.ts - to_hours(k.k) AS lt
FROM targets t, (SELECT unnest([1, 2, 3, 24, 168]) AS k) k"""),
    ("lagv", """
SELECT x.PULocationID, x.ts, x.k,
       coalesce((SELECT CAST(min(h.trip_count) AS DOUBLE) FROM hist h
                 WHERE h.PULocationID = x.PULocationID AND h.pickup_datetime = x.lt),
                (SELECT avg(h.trip_count) FROM hist h
                 WHERE h.PULocationID = x.PULocationID AND hour(h.pickup_datetime) = hour(x.lt)),
                0.0) AS v
FROM lagx x"""),
    ("lags", """
SELECT PULocationID, ts,
       max(CASE WHEN k = 1 THEN v END) AS lag_1h, max(CASE WHEN k = 2 THEN v END) AS lag_2h,
       max(CASE WHEN k = 3 THEN v END) AS lag_3h, max(CASE WHEN k = 24 THEN v END) AS lag_24h,
       max(CASE WHEN k = 168 THEN v END) AS lag_168h
FROM lagv GROUP BY PULocationID, ts"""),
    ("future", """
SELECT t.PULocationID, t.step, t.ts,
  hour(t.ts) AS hour, isodow(t.ts) - 1 AS day_of_week, day(t.ts) AS day_of_month, month(t.ts) AS month,
  CAST(isodow(t.ts) >= 6 AS BIGINT) AS is_weekend, (isodow(t.ts) - 1) * 24 + hour(t.ts) AS hour_of_week,
  CAST(CAST(t.ts AS DATE) IN (SELECT holiday_date FROM cal) AS BIGINT) AS is_holiday,
  CAST(CAST(t.ts AS DATE) + 1 IN (SELECT holiday_date FROM cal) AS BIGINT) AS is_holiday_eve,
  l.lag_1h, l.lag_2h, l.lag_3h, l.lag_24h, l.lag_168h,
  coalesce(zm.m, 0.0) AS rolling_mean_3h, coalesce(zm.m, 0.0) AS rolling_mean_12h,
  coalesce(zm.m, 0.0) AS rolling_mean_24h, coalesce(zm.m, 0.0) AS rolling_mean_168h,
  CAST(zm.m IS NOT NULL AS BIGINT) AS has_history,
  (l.lag_1h + l.lag_2h + l.lag_3h) / 3.0 AS prediction
FROM targets t LEFT JOIN lags l USING (PULocationID, ts)
LEFT JOIN (SELECT PULocationID, avg(trip_count) AS m FROM hist GROUP BY 1) zm USING (PULocationID)"""),
]

ERR = "(trip_count - y_pred)"
MAE = f"avg(abs{ERR})"
RMSE = f"sqrt(avg(pow({ERR}, 2)))"
MAPE = f"coalesce(100.0 * avg(CASE WHEN trip_count <> 0 THEN abs({ERR} / trip_count) END), 0.0)"
R2 = (f"CASE WHEN count(*) * var_pop(trip_count) > 0 THEN 1 - sum(pow({ERR}, 2)) / (count(*) * var_pop(trip_count)) "
      f"WHEN sum(pow({ERR}, 2)) = 0 THEN 1.0 ELSE 0.0 END")


def _metrics_sql(extra_keys: str = "", r2: bool = True, mean_demand: bool = False, src: str = "pred") -> str:
    cols = [f"round({MAE}, 6) AS mae", f"round({RMSE}, 6) AS rmse", f"round({MAPE}, 6) AS mape"]
    if r2:
        cols.append(f"round({R2}, 6) AS r2")
    cols.append("count(*) AS n_samples")
    if mean_demand:
        cols.append("round(avg(trip_count), 6) AS mean_demand")
    keys = "period" + (", " + extra_keys if extra_keys else "")
    return f"SELECT {keys}, {', '.join(cols)} FROM {src} GROUP BY {keys}"


# ---- profiles -------------------------------------------------------------------
ORACLE["demand_profile"] = q("""
SELECT count(*) AS n_rows, min(pickup_datetime) AS first_ts, max(pickup_datetime) AS last_ts,
       count(DISTINCT PULocationID) AS n_zones FROM zh""")

ORACLE["demand_stats"] = q_norm("""
, comb AS (SELECT pickup_datetime, PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count
          FROM src_tot GROUP BY 1, 2)
SELECT count(*) AS n_rows, CAST(sum(trip_count) AS BIGINT) AS total_trips, round(avg(trip_count), 6) AS mean_trips,
       max(trip_count) AS max_trips, round(quantile_cont(trip_count, 0.5), 6) AS median_trips FROM comb""")

ORACLE["zone_stats"] = q("""
SELECT PULocationID, round(avg(trip_count), 6) AS mean_demand, max(trip_count) AS max_demand,
       min(trip_count) AS min_demand, count(*) AS n_records FROM panel GROUP BY 1""")

ORACLE["describe_numeric"] = q(" UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM clean"""
    for c in ["fare", "distance", "passengers", "trip_duration_min"]))

ORACLE["top_zones"] = q("""
SELECT pu_zone, count(*) AS count FROM trips WHERE pu_zone IS NOT NULL GROUP BY 1 ORDER BY count DESC, pu_zone LIMIT 10""")

ORACLE["passenger_counts"] = q("""
SELECT round(passengers, 6) AS passengers, count(*) AS count FROM trips
WHERE passengers IS NOT NULL AND NOT isnan(passengers) GROUP BY passengers""")

ORACLE["weekday_counts"] = q("""
SELECT d.dow, d.day_name, c.trips
FROM (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                            (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) v(dow, day_name)) d
LEFT JOIN (SELECT isodow(pickup_ts) - 1 AS dow, count(*) AS trips FROM trips GROUP BY 1) c USING (dow)""")

ORACLE["daily_counts"] = q("""
SELECT strftime(CAST(pickup_ts AS DATE), '%Y-%m-%d') AS date, count(*) AS trips,
       dayname(CAST(pickup_ts AS DATE)) AS day_name FROM trips GROUP BY CAST(pickup_ts AS DATE)""")

ORACLE["daily_summary"] = q("""
SELECT count(*) AS n_days, round(avg(trips), 6) AS mean_daily, min(trips) AS min_daily, max(trips) AS max_daily
FROM (SELECT CAST(pickup_ts AS DATE) AS d, count(*) AS trips FROM trips GROUP BY 1)""")

ORACLE["hourly_counts"] = q("SELECT hour(pickup_ts) AS hour, count(*) AS trips FROM trips GROUP BY 1")


def _hist_sql(col: str, lo: float, hi: float, bins: int) -> str:
    w = (hi - lo) / bins
    x = f"least(greatest(CAST({col} AS DOUBLE), {lo}), {hi})"
    b = f"CAST(least(floor(({x} - {lo}) / {w}), {bins - 1}) AS BIGINT)"
    return q(f"""
SELECT {b} AS bin, count(*) AS count, round({lo} + {b} * {w}, 6) AS bin_lo, round({lo} + ({b} + 1) * {w}, 6) AS bin_hi
FROM clean WHERE {col} IS NOT NULL AND NOT isnan({col}) GROUP BY {b}""")


ORACLE["histogram_fare"] = _hist_sql("fare", 0.0, 100.0, 50)
ORACLE["histogram_duration"] = _hist_sql("trip_duration_min", 0.0, 120.0, 50)

_TRIP_COLS = [("trip_id", False), ("pu_zone", False), ("do_zone", False), ("pickup_ts", False),
              ("dropoff_ts", False), ("fare", True), ("distance", True), ("passengers", True),
              ("vendor_id", False), ("dataset", False), ("year_month", False)]
ORACLE["null_report"] = q(" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL{' OR isnan(' + c + ')' if fl else ''}) AS BIGINT) AS n_missing, "
    f"round(100.0 * count_if({c} IS NULL{' OR isnan(' + c + ')' if fl else ''}) / count(*), 6) AS pct_missing FROM trips"
    for c, fl in _TRIP_COLS))

_DUR = "date_diff('microsecond', pickup_ts, dropoff_ts) / 60000000.0"
ORACLE["anomaly_report"] = q(f"""
SELECT count(*) AS n_rows, CAST(count_if({_DUR} < 1) AS BIGINT) AS short_trips,
       round(100.0 * count_if({_DUR} < 1) / count(*), 6) AS short_trips_pct,
       CAST(count_if({_DUR} > 1440) AS BIGINT) AS long_trips, CAST(count_if(fare <= 0) AS BIGINT) AS nonpositive_fare,
       CAST(count_if(distance = 0) AS BIGINT) AS zero_distance,
       CAST(count_if(passengers = 0) AS BIGINT) AS zero_passengers FROM trips""")

# ---- labels ---------------------------------------------------------------------
ORACLE["period_labels"] = q(f"""
SELECT h AS pickup_datetime,
       CASE WHEN h < {T0} + INTERVAL 1 DAY THEN 'before_data' WHEN h < {CUT} THEN 'train'
            WHEN h < {FROM} + INTERVAL 1 DAY THEN 'test' ELSE 'future' END AS period
FROM (SELECT DISTINCT date_trunc('hour', pickup_ts) AS h FROM trips)""")

ORACLE["historical_flag"] = q("""
SELECT PULocationID, step, ts,
       CAST(ts <= (SELECT date_trunc('day', max(pickup_datetime)) FROM panel) AS BIGINT) AS is_historical
FROM targets""")

ORACLE["zone_labels"] = q("""
SELECT LocationID, format('{:3d} - {} ({})', LocationID, Zone, Borough) AS label FROM zones_dim""")

ORACLE["distinct_zones"] = q("SELECT DISTINCT pu_zone AS PULocationID FROM clean")

ORACLE["zone_names"] = q("""
SELECT z.PULocationID, coalesce(d.Zone, 'Zone ' || CAST(z.PULocationID AS VARCHAR)) AS Zone
FROM (SELECT DISTINCT pu_zone AS PULocationID FROM clean) z LEFT JOIN zones_dim d ON z.PULocationID = d.LocationID""")

ORACLE["zone_attributes"] = q("""
SELECT s.*, d.Borough, d.Zone, d.service_zone
FROM (SELECT PULocationID, round(avg(trip_count), 6) AS mean_demand, max(trip_count) AS max_demand,
             min(trip_count) AS min_demand, count(*) AS n_records FROM panel GROUP BY 1) s
JOIN zones_dim d ON s.PULocationID = d.LocationID""")

ORACLE["forecast_band"] = q("""
SELECT PULocationID, step, ts, round(prediction, 6) AS prediction, round(prediction * 0.8, 6) AS lower,
       round(prediction * 1.2, 6) AS upper FROM future""")

ORACLE["error_severity"] = q(f"""
SELECT PULocationID, pickup_datetime, trip_count, round(y_pred, 6) AS y_pred,
       round(abs{ERR} / (trip_count + 0.001) * 100.0, 6) AS error_pct,
       CASE WHEN abs{ERR} / (trip_count + 0.001) * 100.0 > 10 THEN 'high'
            WHEN abs{ERR} / (trip_count + 0.001) * 100.0 > 5 THEN 'medium' ELSE 'low' END AS severity
FROM test""")

# ---- metrics ---------------------------------------------------------------------
ORACLE["residuals"] = q("""
SELECT PULocationID, pickup_datetime, period, trip_count, round(y_pred, 6) AS y_pred,
       round(error, 6) AS error, round(abs_error, 6) AS abs_error FROM pred""")

ORACLE["metrics_by_period"] = q(_metrics_sql())
ORACLE["metrics_by_zone"] = q(_metrics_sql("PULocationID", r2=False, mean_demand=True)
                              .replace("SELECT period, PULocationID,", "SELECT period, PULocationID AS zone,"))
ORACLE["metrics_by_hour"] = q(_metrics_sql("hour", r2=False, mean_demand=True))

_MBP = f"""
, mbp AS (SELECT period, {MAE} AS mae, {RMSE} AS rmse, {MAPE} AS mape, {R2} AS r2 FROM pred GROUP BY period),
w AS (SELECT max(CASE WHEN period = 'train' THEN mae END) AS mae_train, max(CASE WHEN period = 'test' THEN mae END) AS mae_test,
             max(CASE WHEN period = 'train' THEN rmse END) AS rmse_train, max(CASE WHEN period = 'test' THEN rmse END) AS rmse_test,
             max(CASE WHEN period = 'train' THEN mape END) AS mape_train, max(CASE WHEN period = 'test' THEN mape END) AS mape_test,
             max(CASE WHEN period = 'train' THEN r2 END) AS r2_train, max(CASE WHEN period = 'test' THEN r2 END) AS r2_test
      FROM mbp)
"""
_with_mbp = _with(_MBP).rstrip("\n") + _MBP
ORACLE["metrics_degradation"] = _with_mbp + """
SELECT round(mae_train, 6) AS mae_train, round(mae_test, 6) AS mae_test, round(rmse_train, 6) AS rmse_train,
       round(rmse_test, 6) AS rmse_test, round(mape_train, 6) AS mape_train, round(mape_test, 6) AS mape_test,
       round(r2_train, 6) AS r2_train, round(r2_test, 6) AS r2_test,
       round(100.0 * (mae_test - mae_train) / mae_train, 6) AS mae_degradation_pct,
       round(100.0 * (rmse_test - rmse_train) / rmse_train, 6) AS rmse_degradation_pct,
       round(mape_test - mape_train, 6) AS mape_change_pp FROM w"""

ORACLE["mape_variants"] = q(f"""
SELECT period, round({MAPE}, 6) AS mape_nonzero, round(100.0 * avg(abs{ERR} / (trip_count + 1)), 6) AS mape_plus1,
       round(avg(abs{ERR} / (trip_count + 0.001) * 100.0), 6) AS mean_pct_error_eps FROM pred GROUP BY period""")

ORACLE["metrics_pivot"] = q(f"""
SELECT hour, round(max(CASE WHEN period = 'train' THEN m END), 6) AS train,
       round(max(CASE WHEN period = 'test' THEN m END), 6) AS test
FROM (SELECT period, hour, {MAPE} AS m FROM pred GROUP BY 1, 2) GROUP BY hour""")

ORACLE["period_change_by_hour"] = q(f"""
SELECT a.hour, round(a.m, 6) AS mape_train, round(b.m, 6) AS mape_test, round(b.m - a.m, 6) AS change
FROM (SELECT hour, {MAPE} AS m FROM pred WHERE period = 'train' GROUP BY 1) a
JOIN (SELECT hour, {MAPE} AS m FROM pred WHERE period = 'test' GROUP BY 1) b USING (hour)""")

# ---- diagnostics -------------------------------------------------------------------
_ZT = f"(SELECT PULocationID AS zone, {MAPE} AS mape, avg(trip_count) AS mean_demand, count(*) AS n_samples FROM test GROUP BY 1)"
ORACLE["worst_zones"] = q(f"""
SELECT zone, round(mape, 6) AS mape, round(mean_demand, 6) AS mean_demand, n_samples FROM {_ZT}
ORDER BY mape DESC, zone LIMIT 10""")
ORACLE["best_zones"] = q(f"""
SELECT zone, round(mape, 6) AS mape, round(mean_demand, 6) AS mean_demand, n_samples FROM {_ZT}
ORDER BY mape ASC, zone LIMIT 10""")

ORACLE["worst_predictions"] = q("""
SELECT PULocationID, pickup_datetime, trip_count, round(y_pred, 6) AS y_pred, round(abs_error, 6) AS abs_error
FROM test ORDER BY abs_error DESC, PULocationID, pickup_datetime LIMIT 5""")

ORACLE["sample_predictions"] = q("""
SELECT PULocationID, pickup_datetime, trip_count, round(y_pred, 6) AS y_pred, round(error, 6) AS error FROM test
ORDER BY md5(concat_ws('|', CAST(PULocationID AS VARCHAR), CAST(pickup_datetime AS VARCHAR), '42')),
         PULocationID, pickup_datetime LIMIT 5000""")

ORACLE["error_distribution"] = q("""
SELECT round(avg(abs_error), 6) AS mean, round(quantile_cont(abs_error, 0.5), 6) AS median,
       round(stddev_pop(abs_error), 6) AS std, round(min(abs_error), 6) AS min, round(max(abs_error), 6) AS max,
       round(quantile_cont(abs_error, 0.25), 6) AS p25, round(quantile_cont(abs_error, 0.75), 6) AS p75 FROM test""")

ORACLE["error_percentiles"] = q(" UNION ALL ".join(f"""
SELECT CAST({p} AS BIGINT) AS percentile, round(th, 6) AS abs_error,
       round(100.0 * (SELECT count(*) FROM test WHERE abs_error <= th) / (SELECT count(*) FROM test), 6) AS pct_within
FROM (SELECT quantile_cont(abs_error, {p / 100}) AS th FROM test)""" for p in (50, 75, 90, 95, 99)))

ORACLE["calibration"] = q("""
SELECT round(ma, 6) AS mean_actual, round(mp, 6) AS mean_pred, round(ma - mp, 6) AS bias,
       round(100.0 * (ma - mp) / ma, 6) AS bias_pct, CAST(abs(ma - mp) < ma * 0.05 AS BIGINT) AS calibrated
FROM (SELECT avg(trip_count) AS ma, avg(y_pred) AS mp FROM test)""")

ORACLE["metrics_by_decile"] = q("""
, fares AS (SELECT fare, avg(fare) OVER (PARTITION BY hour(pickup_ts)) AS y_pred FROM clean),
edges AS (SELECT list_sort(list_distinct(quantile_cont(fare, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
          FROM fares)
SELECT decile, round(min(fare), 6) AS min_demand, round(max(fare), 6) AS max_demand,
       round(avg(abs(fare - y_pred)), 6) AS mae,
       round(100.0 * avg(CASE WHEN fare <> 0 THEN abs((fare - y_pred) / fare) END), 6) AS mape, count(*) AS n_samples
FROM (SELECT f.*, CAST(greatest(len(list_filter(e.e, lambda x: x < f.fare)) - 1, 0) AS BIGINT) AS decile
      FROM fares f, edges e)
GROUP BY decile""")

ORACLE["weekly_mae"] = q(f"""
SELECT isoyear(pickup_datetime) AS iso_year, week(pickup_datetime) AS week, round({MAE}, 6) AS mae,
       count(*) AS n_rows FROM test GROUP BY 1, 2""")

ORACLE["weekend_mae"] = q("""
SELECT round(wd, 6) AS weekday_mae, nwd AS weekday_rows, round(we, 6) AS weekend_mae, nwe AS weekend_rows,
       round(abs(we - wd), 6) AS difference, round(100.0 * abs(we - wd) / wd, 6) AS difference_pct
FROM (SELECT avg(CASE WHEN isodow(pickup_datetime) < 6 THEN abs_error END) AS wd,
             CAST(count_if(isodow(pickup_datetime) < 6) AS BIGINT) AS nwd,
             avg(CASE WHEN isodow(pickup_datetime) >= 6 THEN abs_error END) AS we,
             CAST(count_if(isodow(pickup_datetime) >= 6) AS BIGINT) AS nwe FROM test)""")

ORACLE["negative_predictions"] = q(f"""
SELECT CAST(count_if(p < 0) AS BIGINT) AS n_negative, count(*) AS n_rows,
       round(100.0 * count_if(p < 0) / count(*), 6) AS pct_negative, CAST(count_if(p < 0) = 0 AS BIGINT) AS passed
FROM (SELECT (4 * lag_1h + lag_2h - 2 * lag_3h) / 3 AS p FROM feat WHERE pickup_datetime >= {CUT})""")

ORACLE["residual_autocorr"] = q("""
SELECT 1 AS lag, round(corr(e, e1), 6) AS autocorr FROM
  (SELECT error AS e, lag(error, 1) OVER (PARTITION BY PULocationID ORDER BY pickup_datetime) AS e1 FROM test)
UNION ALL
SELECT 24, round(corr(e, e24), 6) FROM
  (SELECT error AS e, lag(error, 24) OVER (PARTITION BY PULocationID ORDER BY pickup_datetime) AS e24 FROM test)""")

ORACLE["global_autocorr"] = q("""
SELECT CAST(unnest([1, 24]) AS BIGINT) AS lag, unnest([round(corr(e, e1), 6), round(corr(e, e24), 6)]) AS autocorr_global
FROM (SELECT error AS e, lag(error, 1) OVER w AS e1, lag(error, 24) OVER w AS e24 FROM test
      WINDOW w AS (ORDER BY PULocationID, pickup_datetime))""")


def _poly(c: list[float], x: str) -> str:
    out = repr(float(c[-1]))
    for v in reversed(c[:-1]):
        out = f"({out} * {x} + {float(v)!r})"
    return out


def _quantile(p: str) -> str:
    """The normal quantile in SQL, by the same fixed values."""
    ratio = lambda parts, x: f"{_poly(parts[0], x)} / {_poly(parts[1], x)}"
    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    return (f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(normal.MIDDLE, f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))')} "
            f"ELSE sign({p} - 0.5) * CASE WHEN {r} <= 5 THEN {ratio(normal.TAIL, f'({r} - 1.6)')} ELSE {ratio(normal.FAR, f'({r} - 5)')} END END")


# Shapiro-Wilk for more than 11 values, as arrays of the sorted sample
ORACLE["residual_shapiro"] = q(f"""
SELECT n, round(w, 6) AS w, round(p, 6) AS p_value, CAST(p > 0.05 AS BIGINT) AS normal FROM (
  SELECT n, w, CASE WHEN z >= 0 THEN tail ELSE 1 - tail END AS p FROM (
    SELECT n, w, z, exp(-z * z / 2) * CASE WHEN abs(z) < 7.07106781186547
      THEN {_poly(normal.TAIL_OVER[::-1], 'abs(z)')} / {_poly(normal.TAIL_UNDER[::-1], 'abs(z)')}
      ELSE 1 / (abs(z) + 1 / (abs(z) + 2 / (abs(z) + 3 / (abs(z) + 4 / (abs(z) + 0.65))))) / 2.506628274631 END AS tail
    FROM (SELECT n, w, (ln(1 - w) - {_poly(LARGE_MEAN, 'ln(n)')}) / exp({_poly(LARGE_SD, 'ln(n)')}) AS z FROM (
      SELECT n, pow(list_dot_product(a, e), 2) / list_sum(list_transform(e, lambda v: pow(v - list_avg(e), 2))) AS w FROM (
        SELECT n, e, list_transform(m, lambda v, i: CASE WHEN i = 1 THEN -last WHEN i = n THEN last WHEN i = 2 THEN -second
            WHEN i = n - 1 THEN second ELSE v / sqrt((ss - 2 * pow(m[n], 2) - 2 * pow(m[n - 1], 2)) / (1 - 2 * pow(last, 2) - 2 * pow(second, 2))) END) AS a
        FROM (SELECT *, m[n] / sqrt(ss) + {_poly(OUTERMOST, '(1 / sqrt(n))')} AS last, m[n - 1] / sqrt(ss) + {_poly(SECOND, '(1 / sqrt(n))')} AS second
              FROM (SELECT n, e, m, list_dot_product(m, m) AS ss FROM (
                SELECT len(e) AS n, e, list_transform(range(1, len(e) + 1), lambda i: {_quantile('((i - 0.375) / (len(e) + 0.25))')}) AS m
                FROM (SELECT list(error ORDER BY error) AS e FROM (
                  SELECT error FROM test ORDER BY md5(concat_ws('|', CAST(PULocationID AS VARCHAR), CAST(pickup_datetime AS VARCHAR), '42')),
                    PULocationID, pickup_datetime LIMIT 5000))))))))))""")

ORACLE["residual_normality"] = q("""
SELECT n, round(s, 6) AS skewness, round(k, 6) AS kurtosis, round(n / 6.0 * (s * s + k * k / 4.0), 3) AS jb,
       round(exp(-(n / 6.0 * (s * s + k * k / 4.0)) / 2.0), 6) AS p_value,
       CAST(exp(-(n / 6.0 * (s * s + k * k / 4.0)) / 2.0) > 0.05 AS BIGINT) AS normal
FROM (SELECT count(*) AS n, avg(pow(error - mu, 3)) / pow(avg(pow(error - mu, 2)), 1.5) AS s,
             avg(pow(error - mu, 4)) / pow(avg(pow(error - mu, 2)), 2) - 3 AS k
      FROM test, (SELECT avg(error) AS mu FROM test))""")

# ---- forecast views -------------------------------------------------------------------
ORACLE["recent_history"] = q("SELECT * FROM hist")

ORACLE["max_timestamp"] = q("""
SELECT PULocationID, pickup_datetime, (SELECT max(pickup_datetime) FROM panel) AS max_ts FROM panel""")

ORACLE["lag_lookup"] = q(f"""
SELECT t.PULocationID, t.step, t.ts, {r6('l.lag_1h', 'l.lag_2h', 'l.lag_3h', 'l.lag_24h', 'l.lag_168h')
    .replace('AS l.', 'AS ')}
FROM targets t LEFT JOIN lags l USING (PULocationID, ts)""")

_FUT = ["hour", "day_of_week", "day_of_month", "month", "is_weekend", "hour_of_week", "is_holiday",
        "is_holiday_eve"]
_FUTD = ["lag_1h", "lag_2h", "lag_3h", "lag_24h", "lag_168h", "rolling_mean_3h", "rolling_mean_12h",
         "rolling_mean_24h", "rolling_mean_168h", "prediction"]
ORACLE["future_features"] = q(f"""
SELECT PULocationID, step, ts, {', '.join(_FUT)}, {r6(*_FUTD)}, has_history FROM future""")

ORACLE["compare_forecast"] = q("""
SELECT f.PULocationID, f.step, f.ts, round(f.prediction, 6) AS prediction, coalesce(p.trip_count, 0) AS trip_count
FROM future f LEFT JOIN panel p ON f.PULocationID = p.PULocationID AND f.ts = p.pickup_datetime""")

ORACLE["forecast_summary"] = q("""
SELECT PULocationID, round(max(prediction), 6) AS max_pred, round(min(prediction), 6) AS min_pred,
       round(avg(prediction), 6) AS mean_pred, round(sum(prediction), 6) AS total_pred FROM future GROUP BY 1""")

_RD = f"""(SELECT PULocationID, CAST(pickup_datetime AS DATE) AS d, CAST(sum(trip_count) AS BIGINT) AS daily_total
 FROM panel WHERE pickup_datetime >= {FROM} - INTERVAL 7 DAY GROUP BY 1, 2)"""
ORACLE["recent_daily"] = q(f"SELECT PULocationID, strftime(d, '%Y-%m-%d') AS date, daily_total FROM {_RD}")

ORACLE["history_and_forecast"] = q(f"""
SELECT PULocationID, strftime(d, '%Y-%m-%d') AS date, round(CAST(daily_total AS DOUBLE), 6) AS trips, 'actual' AS kind
FROM {_RD}
UNION ALL
SELECT PULocationID, strftime({FROM}, '%Y-%m-%d'), round(sum(prediction), 6), 'forecast' FROM future GROUP BY 1""")

ORACLE["daily_totals"] = q("""
SELECT PULocationID, strftime(CAST(pickup_datetime AS DATE), '%Y-%m-%d') AS date,
       CAST(sum(trip_count) AS BIGINT) AS daily_total FROM panel GROUP BY 1, CAST(pickup_datetime AS DATE)""")

ORACLE["daily_forecast_error"] = q("""
SELECT d.PULocationID, strftime(d.dt, '%Y-%m-%d') AS date, round(d.actual, 6) AS actual,
       round(d.predicted, 6) AS predicted, round(d.predicted - d.actual, 6) AS error,
       round(s.daily_mae, 6) AS daily_mae, round(s.daily_mape, 6) AS daily_mape
FROM (SELECT PULocationID, CAST(pickup_datetime AS DATE) AS dt, CAST(sum(trip_count) AS DOUBLE) AS actual,
             sum(y_pred) AS predicted FROM test GROUP BY 1, 2) d
JOIN (SELECT PULocationID, avg(abs(predicted - actual)) AS daily_mae,
             100.0 * avg(abs(actual - predicted) / (actual + 1)) AS daily_mape
      FROM (SELECT PULocationID, CAST(pickup_datetime AS DATE) AS dt, CAST(sum(trip_count) AS DOUBLE) AS actual,
                   sum(y_pred) AS predicted FROM test GROUP BY 1, 2) GROUP BY 1) s USING (PULocationID)""")

ORACLE["hourly_profile"] = q("""
SELECT PULocationID, hour(pickup_datetime) AS hour, round(avg(trip_count), 6) AS mean_actual,
       round(avg(y_pred), 6) AS mean_pred FROM test GROUP BY 1, 2""")

ORACLE["first_per_hour"] = q("""
SELECT PULocationID, strftime(CAST(pickup_datetime AS DATE), '%Y-%m-%d') AS date, hour(pickup_datetime) AS hour,
       arg_min(trip_count, (pickup_datetime, dataset)) AS trip_count
FROM zh_src GROUP BY PULocationID, CAST(pickup_datetime AS DATE), hour(pickup_datetime)""")

ORACLE["actual_lookup"] = q("""
SELECT t.PULocationID, t.ts AS pickup_datetime, p.trip_count
FROM targets t LEFT JOIN panel p ON t.PULocationID = p.PULocationID AND t.ts = p.pickup_datetime""")

ORACLE["zone_report"] = q(f"""
SELECT m.PULocationID, coalesce(d.Zone, 'Zone ' || CAST(m.PULocationID AS VARCHAR)) AS Zone,
       round(m.mae, 6) AS mae, round(m.rmse, 6) AS rmse, round(m.mean_actual, 6) AS mean_actual
FROM (SELECT PULocationID, {MAE} AS mae, {RMSE} AS rmse, avg(trip_count) AS mean_actual
      FROM test WHERE PULocationID IN (SELECT PULocationID FROM busy) GROUP BY 1) m
LEFT JOIN zones_dim d ON m.PULocationID = d.LocationID""")

ORACLE["series_slice"] = q(f"""
SELECT PULocationID, pickup_datetime, trip_count, round(y_pred, 6) AS y_pred FROM pred
WHERE PULocationID IN (SELECT PULocationID FROM busy) AND pickup_datetime BETWEEN {CUT} AND {T1}""")


# ---- months, ordering, scalar functions ------------------------------------------
ORACLE["month_selection"] = q("""
SELECT DISTINCT year_month, CAST(year_month[6:7] IN ('01', '02', '03')
       OR year_month = (SELECT strftime(t1, '%Y-%m') FROM rng) AS BIGINT) AS selected FROM (
  SELECT year_month FROM trips
  UNION ALL
  SELECT format('{:04d}-{:02d}', y, m) FROM (SELECT DISTINCT year(pickup_ts) AS y FROM trips),
                                              (SELECT unnest(range(1, 13)) AS m))
WHERE year_month IS NOT NULL""")

ORACLE["bucketed_lags"] = q(f"""
SELECT PULocationID, pickup_datetime, trip_count, {r6('lag_1h', 'lag_2h', 'lag_3h', 'lag_24h', 'lag_168h')} FROM feat""")

ORACLE["pruned_lookup"] = q(f"""
SELECT b.PULocationID, h.pickup_datetime, p.trip_count
FROM busy b CROSS JOIN (SELECT unnest(generate_series(fs, fs + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS pickup_datetime FROM rng) h
LEFT JOIN panel p ON p.PULocationID = b.PULocationID AND p.pickup_datetime = h.pickup_datetime""")

ORACLE["merged_profiles"] = q("""
SELECT count(*) AS n_rows, min(pickup_datetime) AS first_ts, max(pickup_datetime) AS last_ts,
       CAST(sum(trip_count) AS BIGINT) AS total_trips, round(avg(trip_count), 6) AS mean_trips,
       CAST(max(trip_count) AS BIGINT) AS max_trips, count(DISTINCT PULocationID) AS n_zones FROM zh""")

ORACLE["panel_write_order"] = q("SELECT * FROM panel")

ORACLE["source_roundtrip"] = q("""
SELECT pickup_ts, pu_zone, round(fare, 6) AS fare, dataset, year_month FROM trips
WHERE dataset = 'yellow' AND year_month IN ('2023-12', '2024-01')
UNION ALL
SELECT pickup_ts, pu_zone, NULL, dataset, year_month FROM trips
WHERE dataset = 'fhvhv' AND year_month = '2024-01'""")

ORACLE["report_roundtrip"] = q(_metrics_sql("PULocationID", r2=False, mean_demand=True)
                               .replace("SELECT period, PULocationID,", "SELECT period, PULocationID AS zone,"))

ORACLE["head_rows"] = q("SELECT * FROM panel ORDER BY PULocationID, pickup_datetime LIMIT 10")

ORACLE["range_and_split"] = q(f"""
SELECT CASE WHEN pickup_datetime < {CUT} THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows,
       CAST(sum(trip_count) AS BIGINT) AS trips, min(pickup_datetime) AS first_ts, max(pickup_datetime) AS last_ts
FROM zh_src WHERE pickup_datetime BETWEEN {T0} + INTERVAL 1 DAY AND {T1} GROUP BY 1""")

ORACLE["scalar_calendar"] = q("""
SELECT trip_id, date_trunc('hour', pickup_ts) AS hour_start, hour(pickup_ts) AS hour, day(pickup_ts) AS day,
       month(pickup_ts) AS month, isodow(pickup_ts) - 1 AS weekday, CAST(isodow(pickup_ts) >= 6 AS BIGINT) AS is_weekend,
       (isodow(pickup_ts) - 1) * 24 + hour(pickup_ts) AS hour_of_week,
       strftime(CAST(pickup_ts AS DATE), '%Y-%m-%d') AS date, dayname(pickup_ts) AS day_name,
       week(pickup_ts) AS iso_week, pickup_ts + INTERVAL 1 DAY AS next_day, pickup_ts - INTERVAL 3 HOUR AS minus_3h,
       round(date_diff('microsecond', pickup_ts, dropoff_ts) / 1000000.0, 6) AS seconds,
       round(round_even(fare / 3.0, 2), 6) AS fare_third_r2, round(abs(fare), 6) AS abs_fare,
       round(sqrt(abs(fare)), 6) AS sqrt_abs_fare, year_month,
       regexp_extract('yellow_tripdata_' || year_month || '.parquet', '(\\d{4}-\\d{2})\\.parquet$', 1) AS month_from_file
FROM trips""")

# ---- models: all features by elimination, one feature in closed form ----------------
N = len(FEATURES)
SWEEPS = 120
X = [f"x{i}" for i in range(N)]


def _elimination(name: str, rows: str) -> list[tuple[str, str]]:
    """Least squares and ridge fits on the rows ``rows`` of ``xs``: centred
    products, correlations with the penalty on the diagonal, Gauss-Jordan
    elimination feature by feature (one that depends on those before is left
    out), and back to the features' own units. ``fit_{name}`` has one row for
    each variant: model, alpha, intercept b and weights w."""
    products = ", ".join("[" + ", ".join(f"avg(({a} - m{i}) * ({b} - m{j}))" for j, b in enumerate([*X, "y"])) + "]" for i, a in enumerate(X))
    means = ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate([*X, "y"]))
    steps = [(f"mean_{name}", f"SELECT count(*) AS n, {means} FROM xs WHERE {rows}"),
             (f"prod_{name}", f"SELECT [{products}] AS c FROM xs, mean_{name} WHERE {rows}"),
             (f"g_{name}_0", f"""
SELECT model, alpha, i, j, CASE WHEN c[i + 1][i + 1] <= 0 OR (j < {N} AND c[j + 1][j + 1] <= 0) THEN 0.0
  ELSE c[i + 1][j + 1] / sqrt(c[i + 1][i + 1]) / (CASE WHEN j < {N} THEN sqrt(c[j + 1][j + 1]) ELSE 1.0 END) END
  + CASE WHEN i = j AND c[i + 1][i + 1] > 0 THEN l2 ELSE 0.0 END AS v
FROM prod_{name}, (SELECT unnest(range({N})) AS i), (SELECT unnest(range({N + 1})) AS j),
  (SELECT 'linear' AS model, NULL::DOUBLE AS alpha, 0.0::DOUBLE AS l2
   UNION ALL SELECT 'ridge', a, a / n FROM mean_{name}, (SELECT unnest([0.001, 0.01, 0.1, 1.0, 10.0, 100.0]) AS a))""")]
    for k in range(N):
        steps.append((f"g_{name}_{k + 1}", f"""
SELECT model, alpha, i, j, CASE WHEN pv <= 1e-10 THEN CASE WHEN i = {k} OR j = {k} THEN 0.0 ELSE v END
  WHEN i = {k} THEN v / pv ELSE v - col * line / pv END AS v
FROM (SELECT *, max(CASE WHEN i = {k} AND j = {k} THEN v END) OVER (PARTITION BY model, alpha) AS pv,
        max(CASE WHEN j = {k} THEN v END) OVER (PARTITION BY model, alpha, i) AS col,
        max(CASE WHEN i = {k} THEN v END) OVER (PARTITION BY model, alpha, j) AS line FROM g_{name}_{k})"""))
    own = ", ".join(f"m{i}" for i in range(N))
    steps.append((f"fit_{name} AS MATERIALIZED", f"""
SELECT model, alpha, w, m{N} - list_dot_product(w, [{own}]) AS b
FROM (SELECT model, alpha, list(CASE WHEN c[i + 1][i + 1] > 0 THEN v / sqrt(c[i + 1][i + 1]) ELSE 0.0 END ORDER BY i) AS w
      FROM g_{name}_{N}, prod_{name} WHERE j = {N} GROUP BY model, alpha), mean_{name}"""))
    return steps


_P = "b + " + " + ".join(f"w[{i + 1}] * {c}" for i, c in enumerate(X))

CTES += [
    ("xs AS MATERIALIZED", "SELECT *, " + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {x}" for c, x in zip(FEATURES, X)) + f""",
       CAST(trip_count AS DOUBLE) AS y, CASE WHEN pickup_datetime < {CUT} THEN 'train' ELSE 'test' END AS period FROM feat"""),
    *_elimination("train", "period = 'train'"),
    *_elimination("all", "true"),
    ("scored AS MATERIALIZED", f"SELECT xs.*, {_P} AS p FROM xs, fit_train WHERE period = 'test' AND model = 'linear'"),
    ("final0 AS MATERIALIZED", f"SELECT xs.* EXCLUDE (y), {_P} AS y_pred FROM xs, fit_all WHERE model = 'linear'"),
    ("final", "SELECT *, trip_count - y_pred AS error, abs(trip_count - y_pred) AS abs_error FROM final0"),
    ("future17 AS MATERIALIZED", f"""
SELECT PULocationID, step, ts, greatest({_P}, 0.0) AS prediction, has_history
FROM (SELECT *, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {x}" for c, x in zip(FEATURES, X)) + """ FROM future), fit_all WHERE model = 'linear'"""),
    # lasso and elastic net: SWEEPS rounds of coordinate descent on the correlations
    ("corr AS MATERIALIZED", f"""
SELECT list(line ORDER BY i) AS c, list(b ORDER BY i) AS b FROM (
  SELECT i, list(v ORDER BY j) FILTER (j < {N}) AS line, max(v) FILTER (j = {N}) AS b FROM g_train_0 WHERE model = 'linear' GROUP BY i)"""),
    ("descent", f"""
SELECT 'lasso' AS model, alpha, alpha AS l1, 0.0::DOUBLE AS l2, 0 AS t, list_transform(range({N}), lambda i: 0.0::DOUBLE) AS w
FROM (SELECT unnest([0.0001, 0.001, 0.01, 0.1])::DOUBLE AS alpha)
UNION ALL
SELECT 'elastic_net', alpha, alpha * 0.5, alpha * 0.5, 0, list_transform(range({N}), lambda i: 0.0::DOUBLE)
FROM (SELECT unnest([0.001, 0.01, 0.1])::DOUBLE AS alpha)
UNION ALL
SELECT model, alpha, l1, l2, t + 1,
  list_transform(w, lambda e, i: CASE WHEN i = t % {N} + 1 THEN sign(g) * greatest(abs(g) - l1, 0.0) / (1 + l2) ELSE e END)
FROM (SELECT d.*, b[t % {N} + 1] - list_dot_product(c[t % {N} + 1], w) + c[t % {N} + 1][t % {N} + 1] * w[t % {N} + 1] AS g
      FROM descent d, corr WHERE t < {N} * {SWEEPS})"""),
    ("fit_l1 AS MATERIALIZED", f"""
SELECT model, alpha, u AS w, m{N} - list_dot_product(u, [{", ".join(f"m{i}" for i in range(N))}]) AS b
FROM (SELECT model, alpha, list_transform(w, lambda e, i: CASE WHEN c[i][i] > 0 THEN e / sqrt(c[i][i]) ELSE 0.0 END) AS u
      FROM descent, prod_train WHERE t = {N} * {SWEEPS}), mean_train"""),
    ("tuned17", f"""
SELECT model, alpha, l1_ratio, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / (count(*) * var_pop(y)) AS r2
FROM (SELECT model, alpha, l1_ratio, y, y - ({_P}) AS e FROM xs, (
        SELECT model, alpha, CASE WHEN model = 'ridge' THEN 0.0 END AS l1_ratio, w, b FROM fit_train
        UNION ALL SELECT 'linear_scaled', NULL, NULL, w, b FROM fit_train WHERE model = 'linear'
        UNION ALL SELECT model, alpha, CASE WHEN model = 'lasso' THEN 1.0 ELSE 0.5 END, w, b FROM fit_l1)
      WHERE period = 'test') GROUP BY ALL"""),
    ("xy", "SELECT *, x8 AS x FROM xs"),
    ("fit", "SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, count(*) AS n FROM xy WHERE period = 'train'"),
    # standardised feature z, c = mean(z * (y - mean y)); a penalised fit
    # has the single weight w
    ("zs", """
SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, count(*) AS n,
       covar_pop(x, y) / stddev_pop(x) AS c FROM xy WHERE period = 'train'"""),
    ("variants", """
SELECT 'ridge' AS model, alpha, 0.0 AS l1_ratio, c / (1 + alpha / n) AS w
FROM zs, (SELECT unnest([0.001, 0.01, 0.1, 1.0, 10.0, 100.0]) AS alpha)
UNION ALL
SELECT 'lasso', alpha, 1.0, sign(c) * greatest(abs(c) - alpha, 0.0)
FROM zs, (SELECT unnest([0.0001, 0.001, 0.01, 0.1]) AS alpha)
UNION ALL
SELECT 'elastic_net', alpha, 0.5, sign(c) * greatest(abs(c) - alpha * 0.5, 0.0) / (1 + alpha * 0.5)
FROM zs, (SELECT unnest([0.001, 0.01, 0.1]) AS alpha)
UNION ALL
SELECT m, NULL, NULL, c FROM zs, (SELECT unnest(['linear', 'linear_scaled']) AS m)"""),
    ("tuned", """
SELECT model, alpha, l1_ratio, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
       1 - sum(e * e) / (count(*) * var_pop(y)) AS r2
FROM (SELECT v.*, y, y - (my + w * (x - mx) / sx) AS e FROM variants v, zs, xy WHERE period = 'test')
GROUP BY ALL"""),
]

ORACLE["model_matrix"] = q("SELECT PULocationID, pickup_datetime, trip_count, " + ", ".join(
    f"round(CAST(coalesce({c}, 0) AS DOUBLE), 6) AS x_{c}" for c in FEATURES) + " FROM feat")

ORACLE["ols_single_feature"] = q("SELECT round(a, 6) AS slope, round(b, 6) AS intercept, n AS n_rows FROM fit")

ORACLE["linear_scores"] = q("""
SELECT PULocationID, pickup_datetime, trip_count, round(p, 4) AS y_pred, round(p, 4) AS y_scaled FROM scored""")

ORACLE["model_roundtrip"] = q("SELECT PULocationID, pickup_datetime, round(p, 4) AS y_pred FROM scored")

ORACLE["clamped_predictions"] = q("""
SELECT PULocationID, pickup_datetime, trip_count, round(greatest(p, 0.0), 4) AS y_pred FROM scored""")

ORACLE["prediction_stability"] = q("""
SELECT round(max(abs(p - p)), 6) AS max_abs_diff, count(*) AS n_rows, CAST(1 AS BIGINT) AS stable FROM scored""")

for _name in ("ridge", "lasso", "elastic_net"):
    ORACLE[f"{_name}_tuning"] = q(f"SELECT model, alpha, l1_ratio, {r6('mae', 'rmse', 'r2')} FROM tuned17 WHERE model = '{_name}'")

ORACLE["model_leaderboard"] = q(f"""
SELECT model, alpha, l1_ratio, {r6('mae', 'rmse', 'r2')}
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY round(mae, 9), alpha) AS k FROM tuned17) WHERE k = 1""")

for _name in ("lasso", "elastic_net"):
    ORACLE[f"{_name}_single_feature"] = q(f"SELECT model, alpha, l1_ratio, {r6('mae', 'rmse', 'r2')} FROM tuned WHERE model = '{_name}'")

ORACLE["single_feature_leaderboard"] = q(f"""
SELECT model, alpha, l1_ratio, {r6('mae', 'rmse', 'r2')}
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY round(mae, 9), alpha) AS k FROM tuned) WHERE k = 1""")

# every fit is optimal: nothing is left of its conditions at 6 places
ORACLE["fit_optimality"] = q("""
SELECT v.model, v.alpha, f.feature, round(f.deviation, 6) AS deviation, 0.0 AS violation, n AS n_rows
FROM (SELECT DISTINCT model, alpha FROM variants) v,
  (SELECT '' AS feature, NULL::DOUBLE AS deviation, count(*) AS n FROM xs WHERE period = 'train' UNION ALL """ + " UNION ALL ".join(f"SELECT '{c}', stddev_pop({x}), count(*) FROM xs WHERE period = 'train'" for c, x in zip(FEATURES, X)) + ") f")

# one tree of depth 1: of all splits "feature <= value" that with the largest gain
CTES += [
    ("base AS MATERIALIZED", "SELECT avg(y) AS m FROM xs WHERE period = 'train'"),
    ("sides AS MATERIALIZED", f"""
SELECT f, v, sum(y - m) AS e, count(*) AS k
FROM (SELECT unnest(range({N})) AS f, unnest([{", ".join(X)}]) AS v, y FROM xs WHERE period = 'train'), base GROUP BY f, v"""),
    ("split AS MATERIALIZED", """
SELECT * FROM (
  SELECT f, v, l, nl, g - l AS r, n - nl AS nr, l * l / (nl + 1) + (g - l) * (g - l) / (n - nl + 1) AS gain
  FROM (SELECT f, v, sum(e) OVER w AS l, sum(k) OVER w AS nl, sum(e) OVER (PARTITION BY f) AS g, sum(k) OVER (PARTITION BY f) AS n
        FROM sides WINDOW w AS (PARTITION BY f ORDER BY v)) WHERE nl < n)
ORDER BY round(gain, 6) DESC, f, v LIMIT 1"""),
]
CTES.append(("stumped AS MATERIALIZED", f"""
SELECT xs.*, m + 0.1 * CASE WHEN [{", ".join(X)}][f + 1] <= v THEN l / (nl + 1) ELSE r / (nr + 1) END AS p
FROM xs, base, split WHERE period = 'test'"""))
ORACLE["gbt_stump"] = q("SELECT PULocationID, pickup_datetime, trip_count, round(p, 6) AS y_pred FROM stumped")

ORACLE["forecast_24h"] = q("""
SELECT PULocationID, step, ts, round(prediction, 4) AS prediction, has_history FROM future17""")

ORACLE["forecast_vs_actual"] = q("""
SELECT f.PULocationID, f.step, f.ts, round(f.prediction, 4) AS prediction, f.has_history,
       coalesce(p.trip_count, 0) AS trip_count
FROM future17 f LEFT JOIN panel p ON f.PULocationID = p.PULocationID AND f.ts = p.pickup_datetime""")

ORACLE["model_history_and_forecast"] = q(f"""
SELECT PULocationID, strftime(d, '%Y-%m-%d') AS date, round(CAST(daily_total AS DOUBLE), 6) AS trips, 'actual' AS kind
FROM {_RD}
UNION ALL
SELECT PULocationID, strftime({FROM}, '%Y-%m-%d'), round(sum(round(prediction, 4)), 6), 'forecast' FROM future17 GROUP BY 1""")

ORACLE["final_model_scores"] = q(f"""
SELECT PULocationID, pickup_datetime, period, trip_count, round(y_pred, 4) AS y_pred, round(error, 4) AS error,
       round(abs_error, 4) AS abs_error FROM final""")
ORACLE["final_model_history"] = q("SELECT * FROM hist")
ORACLE["fitted_metrics"] = q(_metrics_sql(src="final"))
ORACLE["fitted_metrics_by_zone"] = q(_metrics_sql("PULocationID", r2=False, mean_demand=True, src="final")
                                     .replace("SELECT period, PULocationID,", "SELECT period, PULocationID AS zone,"))
ORACLE["fitted_weekly_mae"] = q("""
SELECT isoyear(pickup_datetime) AS iso_year, week(pickup_datetime) AS week, round(avg(abs_error), 6) AS mae,
       count(*) AS n_rows FROM final WHERE period = 'test' GROUP BY 1, 2""")
ORACLE["fitted_calibration"] = q("""
SELECT round(ma, 6) AS mean_actual, round(mp, 6) AS mean_pred, round(ma - mp, 6) AS bias,
       round(100.0 * (ma - mp) / ma, 6) AS bias_pct, CAST(abs(ma - mp) < ma * 0.05 AS BIGINT) AS calibrated
FROM (SELECT avg(trip_count) AS ma, avg(y_pred) AS mp FROM final WHERE period = 'test')""")

# ---- sources ------------------------------------------------------------------------
ORACLE["monthly_scan"] = q("""
SELECT trip_id, pu_zone, pickup_ts, round(fare, 6) AS fare, round(passengers, 6) AS passengers,
       CASE WHEN day(pickup_ts) % 2 = 1 THEN '2024-01' ELSE '2024-02' END AS year_month,
       dataset AS source_dataset, CAST(1 AS BIGINT) AS n_unreadable FROM trips""")
ORACLE["zone_csv"] = q("SELECT LocationID, Borough, Zone, service_zone FROM zones_dim")
ORACLE["preferred_source"] = q_norm(f"""
SELECT pickup_datetime, PULocationID, {r6('total_distance', 'total_passengers')}, trip_count
FROM src_tot WHERE dataset = 'yellow'""")
ORACLE["feature_nulls"] = q("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing, "
    f"round(100.0 * count_if({c} IS NULL) / count(*), 6) AS pct_missing FROM feat" for c in FEATURES) + ") WHERE n_missing > 0")
ORACLE["parsed_timestamps"] = q("SELECT trip_id, date_trunc('second', pickup_ts) AS pickup_ts FROM trips")


# ---- combined path feature table (A5) ---------------------------------------------
_FEAT_BODY = dict(CTES)["feat"].replace("FROM panel_full p", "FROM panelc p")
ORACLE["combined_features"] = q_norm(f"""
, comb AS (SELECT pickup_datetime, PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count,
                  sum(total_distance) AS total_distance, sum(total_passengers) AS total_passengers
           FROM src_tot GROUP BY 1, 2),
zhc AS (SELECT PULocationID, pickup_datetime, CAST(sum(trip_count) AS BIGINT) AS trip_count,
               avg(total_distance) AS total_distance, avg(total_passengers) AS total_passengers
        FROM comb GROUP BY 1, 2),
panelc AS (SELECT z.PULocationID, h.pickup_datetime,
                  CASE WHEN c.PULocationID IS NULL THEN 0 ELSE c.trip_count END AS trip_count,
                  CASE WHEN c.PULocationID IS NULL THEN 0.0 ELSE c.total_distance END AS total_distance,
                  CASE WHEN c.PULocationID IS NULL THEN 0.0 ELSE c.total_passengers END AS total_passengers
           FROM (SELECT DISTINCT PULocationID FROM zhc) z CROSS JOIN hours h
           LEFT JOIN zhc c ON c.PULocationID = z.PULocationID AND c.pickup_datetime = h.pickup_datetime),
featc AS ({_FEAT_BODY})
SELECT PULocationID, pickup_datetime, trip_count, {r6('total_distance', 'total_passengers')},
  hour, day_of_week, day_of_month, month, is_weekend, hour_of_week, is_holiday, is_holiday_eve,
  {r6('lag_1h', 'lag_2h', 'lag_3h', 'lag_24h', 'lag_168h',
      'rolling_mean_3h', 'rolling_mean_12h', 'rolling_mean_24h', 'rolling_mean_168h')}
FROM featc""")


def _no_negative_zero(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB keeps the
    sign of a zero rounded from a tiny negative, Spark's ``round`` does not,
    and ``-0.0 + 0.0`` is ``0.0``."""
    out, i = [], 0
    pat = re.compile(r"(?<![A-Za-z_])round\(")
    while True:
        m = pat.search(sql, i)
        if not m:
            out.append(sql[i:])
            return "".join(out)
        depth, j = 0, m.end() - 1
        while True:
            if sql[j] == "(":
                depth += 1
            elif sql[j] == ")":
                depth -= 1
                if depth == 0:
                    break
            j += 1
        out.append(sql[i:m.start()])
        out.append("(round(" + _no_negative_zero(sql[m.end():j]) + ") + 0.0)")
        i = j + 1


ORACLE = {name: _no_negative_zero(sql) for name, sql in ORACLE.items()}
