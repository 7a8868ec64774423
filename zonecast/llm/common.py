"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder, read by Spark alone (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage for executor loss, like ``checkpoint()``, but keeps the
    table columnar, so later reads prune columns. The folder is removed when
    the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def crc_bucket(key: Column, n: int) -> Column:
    """crc32 of the key written as text, modulo ``n``; a null key counts as
    the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def work_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batch: tuple[pa.Array, ...], rows: int = 200) -> Iterator[tuple[pa.Array, ...]]:
    """An Arrow batch in slices of a few rows, so that a function over it holds
    the Python objects of one slice at a time."""
    for start in range(0, len(batch[0]), rows):
        yield tuple(a.slice(start, rows) for a in batch)


def put(df: DataFrame, **cols: Column) -> DataFrame:
    """Add output columns; an input column of the same name is replaced."""
    return df.withColumns(cols)


def hashed(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add h (a hash of the text) and size (its bytes): what a sample is
    drawn by, so that joins with labels need not carry the text."""
    return df.withColumns({"h": F.xxhash64(text_col), "size": F.octet_length(text_col)})


#: A text is long if it takes more than this many equal shares of the budget.
LONG = 4


def sample_texts(known: DataFrame, texts: DataFrame, docs: dict | int, size: int) -> dict[object, list[str]]:
    """A bounded sample of labelled texts: of each label the ``docs`` (a
    number, or one for each label) different texts of the smallest hashes, as
    many of them as ``size`` bytes hold, the first always. Texts of more than
    ``LONG * size / docs`` bytes come after the others, and those over
    ``size`` last; a text that does not fit is passed over.

    ``known`` has the columns label, h and size, ``texts`` has h and text
    (see :func:`hashed`). Rows are cut down before anything is grouped: the
    number of different texts of a label, the long ones apart, gives the
    share of hashes that holds some four times as many as are wanted. Those
    rows, without texts, are chosen from one by one; texts are fetched last,
    by hash.
    """
    steps = 1 << 20
    known = known.where("label is not null and size > 0").select("label", "h", "size")
    limit = F.lit(docs if isinstance(docs, int) else 0)
    for k, n in ({} if isinstance(docs, int) else docs).items():
        limit = F.when(F.col("label") == F.lit(k), F.lit(n)).otherwise(limit)
    known = known.withColumn("long", F.col("size").cast("long") * limit > F.lit(LONG * size))
    found = {(r["label"], r["long"]): r["n"] for r in known.groupBy("label", "long").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not found:
        return {}
    share = F.lit(0)
    for (k, long), n in found.items():
        wanted = docs if isinstance(docs, int) else docs.get(k, 0)
        part = min(steps, 1 + (4 * wanted + 64) * steps // max(1, n)) if wanted else 0
        share = F.when((F.col("label") == F.lit(k)) & (F.col("long") == F.lit(long)), F.lit(part)).otherwise(share)
    few = known.where(F.pmod(F.shiftright("h", 8), F.lit(steps)) < share).groupBy("label", "h").agg(F.max("size").alias("size"), F.max("long").alias("long"))
    rows, taken, held = [], {}, {}
    for r in few.orderBy("label", F.col("size") > size, "long", "h").collect():
        k = r["label"]
        wanted = docs if isinstance(docs, int) else docs.get(k, 0)
        if taken.get(k, 0) < wanted and (k not in held or held[k] + r["size"] <= size):
            taken[k], held[k] = taken.get(k, 0) + 1, held.get(k, 0) + r["size"]
            rows.append(r)
    # at most docs hashes a label: a bounded list
    wanted = known.sparkSession.createDataFrame([(h,) for h in sorted({r["h"] for r in rows})], "h long")
    text = {r["h"]: r["text"] for r in texts.select("h", "text").join(F.broadcast(wanted), "h").groupBy("h").agg(F.min("text").alias("text")).collect()}
    out: dict[object, list[str]] = {}
    for r in rows:
        out.setdefault(r["label"], []).append(text[r["h"]])
    return out
