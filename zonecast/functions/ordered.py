"""Lags over one global order without a window in a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import materialize


def with_global_lags(df: DataFrame, order: Sequence[str], cols: Sequence[str], lags: Sequence[int],
                     partitions: int | None = None) -> DataFrame:
    """Add ``{col}_lag{k}``: the value ``k`` rows earlier in the order of the
    whole table (NULL for its first ``k`` rows), and ``row``, the row's number
    from 0. The order must be total, or equal rows come in any order.

    The table is range-partitioned and sorted, and written once so that rows
    keep their places. The rows of each partition are counted -- one number a
    partition -- which gives every row its number, and the last ``max(lags)``
    rows of a partition are copied to the next ones that reach back to them.
    A window inside each partition then does the rest.
    """
    spark, reach = df.sparkSession, max(lags)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = materialize(ranged.withColumns({"__part": F.shiftright(place, 33).cast("int"), "__at": place.bitwiseAND(F.lit((1 << 33) - 1))}), "ordered")
    counts = {r["__part"]: r["n"] for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((p, total, counts[p]))
        total += counts[p]
    if not starts:
        starts = [(0, 0, 0)]
    # parts: number, first row and rows of each partition -- as many rows as partitions
    parts = spark.createDataFrame(starts, "__part int, __start long, __n long")
    own = placed.join(F.broadcast(parts), "__part").withColumn("row", F.col("__start") + F.col("__at")).drop("__at", "__start", "__n")
    ends = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).cast("long").alias("s")) for p, s, _ in starts])
    # the partitions behind a row that start within reach of it
    later = F.filter(ends, lambda e: (e["p"] > F.col("__part")) & (e["s"] <= F.col("row") + reach))
    last = F.create_map(*[x for p, s, c in starts for x in (F.lit(p), F.lit(s + c).cast("long"))])
    copies = (own.where(F.col("row") >= last[F.col("__part")] - reach)
                 .withColumn("__to", F.explode(later["p"])).drop("__part").withColumnRenamed("__to", "__part"))
    both = own.withColumn("__own", F.lit(True)).unionByName(copies.withColumn("__own", F.lit(False)))
    w = Window.partitionBy("__part").orderBy("row")
    made = both.select("*", *[F.lag(c, k).over(w).alias(f"{c}_lag{k}") for c in cols for k in lags])
    return made.where("__own").drop("__own", "__part")
