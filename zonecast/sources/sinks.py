"""Sinks: tables, reports and models (K1-K3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from zonecast.operators.boosting import BoostedTrees
from zonecast.operators.linear import LinearModel


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                cluster_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Parquet, overwriting; parents are created by the writer (K1).

    ``partition_by`` (e.g. ``year_month``) lets later scans prune whole
    directories. ``cluster_by`` + ``sort_by`` give the panel's write order
    (O1): rows of a zone land in one file, sorted by time, so row-group
    statistics prune zone and time filters -- a hash shuffle and a local
    sort, not a global sort.
    """
    if cluster_by:
        df = df.repartition(*cluster_by)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_lookup_table(df: DataFrame, path: str, key: str, row_group_bytes: int = 8 << 20, mode: str = "overwrite") -> None:
    """Parquet for point lookups on ``key`` (K1, F8-F10): rows of a key lie
    together in sorted files of small row groups, each with a Bloom filter of
    its keys, so that a scan for a few keys skips the groups without them --
    by their statistics, and by the filter where ranges overlap."""
    (df.repartition(key).sortWithinPartitions(key).write.mode(mode)
       .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", str(row_group_bytes))
       .parquet(path))


def write_bucketed(df: DataFrame, table: str, path: str, bucket_by: Sequence[str], sort_by: Sequence[str], buckets: int) -> DataFrame:
    """A table in the catalog, its files under ``path`` bucketed and sorted
    (K1, S8); gives the table back as it reads.

    One shuffle here, one file a bucket; joins, windows and groupings by the
    bucket columns of whatever reads the table later need no exchange.
    """
    (df.repartition(buckets, *bucket_by).write.mode("overwrite").option("path", path)
       .bucketBy(buckets, *bucket_by).sortBy(*sort_by).saveAsTable(table))
    return df.sparkSession.table(table)


def write_report(df: DataFrame, path: str) -> None:
    """CSV with header as a single file (K2). Reports are aggregates: the
    plan runs once with its own partitions, and only its result rows cross
    the exchange to the one writing task."""
    df.repartition(1).write.mode("overwrite").csv(path, header=True)


def write_csv(df: DataFrame, path: str) -> None:
    """A base table as a folder of CSV files with headers, one for each
    partition, each written by its own task."""
    df.write.mode("overwrite").csv(path, header=True)


def save_model(model: LinearModel | BoostedTrees | PipelineModel, path: str, spark: SparkSession | None = None) -> None:
    """Persist a fitted model (K3): our own as a small parquet table, a
    pipeline with MLlib's writer."""
    if isinstance(model, (LinearModel, BoostedTrees)):
        model.save(spark or SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str, spark: SparkSession | None = None) -> LinearModel | BoostedTrees | PipelineModel:
    """A saved model of any kind; a pipeline has a metadata folder."""
    spark = spark or SparkSession.active()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/metadata")
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return PipelineModel.load(path)
    kind = LinearModel if "coefficients" in spark.read.parquet(path).columns else BoostedTrees
    return kind.load(spark, path)
