"""Trip and table sources.

Monthly files follow ``{base}/{dataset}_tripdata_{yyyy-MM}.parquet`` (a file
or a directory of part files). Existence is tested through the Hadoop
FileSystem of the path, so the same code runs on local disk, HDFS or object
stores.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.time import dataset_from_path, month_from_path
from zonecast.schema import ZONES

_log = logging.getLogger(__name__)
_YM = re.compile(r"^(\d{4})-(\d{2})$")


def select_months(years: Iterable[int] = (), months: Iterable[int] | None = None,
                  year_months: Iterable[str] = ()) -> list[str]:
    """Union of explicit ``yyyy-MM`` values and years x months (default all
    twelve), deduplicated and sorted (S2). Months must be 1..12; explicit
    values must have a year >= 2009."""
    months = list(range(1, 13)) if months is None else list(months)
    for m in months:
        if not 1 <= int(m) <= 12:
            raise ValueError(f"month out of range: {m}")
    out = set()
    for ym in year_months:
        mt = _YM.match(ym)
        if not mt:
            raise ValueError(f"not yyyy-MM: {ym}")
        y, m = int(mt.group(1)), int(mt.group(2))
        if y < 2009 or not 1 <= m <= 12:
            raise ValueError(f"month out of range: {ym}")
        out.add(f"{y:04d}-{m:02d}")
    for y in years:
        for m in months:
            out.add(f"{int(y):04d}-{int(m):02d}")
    return sorted(out)


def month_table(df: DataFrame, time: str, months: Sequence[int] = tuple(range(1, 13))) -> DataFrame:
    """S2 as a table over the data: the months present in ``time`` united
    with every month of the years present, distinct and ordered."""
    present = df.select(F.date_format(time, "yyyy-MM").alias("year_month"))
    years = df.select(F.year(time).alias("y")).distinct()
    grid = (years.select("y", F.explode(F.array(*[F.lit(int(m)) for m in months])).alias("m"))
                 .select(F.format_string("%04d-%02d", "y", "m").alias("year_month")))
    return present.unionByName(grid).where(F.col("year_month").isNotNull()).distinct().orderBy("year_month")


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def month_paths(base: str, dataset: str, months: Sequence[str]) -> list[str]:
    return [f"{base.rstrip('/')}/{dataset}_tripdata_{m}.parquet" for m in months]


def _listed(spark: SparkSession, base: str, dataset: str) -> list[str]:
    """The monthly files of a dataset that are there, by the Hadoop
    FileSystem of the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{dataset}_tripdata_*.parquet")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(f.getPath().toString() for f in found) if found else []


def _common_type(types: Sequence[T.DataType]) -> T.DataType:
    """The type that the months' types of one column are read as: numbers
    widen to bigint or double, timestamps become naive, others text."""
    kinds = {t.simpleString() for t in types}
    if len(kinds) == 1:
        return types[0]
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType)) for t in types):
        return T.TimestampNTZType()
    return T.StringType()


def scan_trips(spark: SparkSession, base: str, dataset: str, months: Sequence[str] | None = None,
               columns: Sequence[str] | None = None, schema: T.StructType | None = None,
               unreadable: list[str] | None = None) -> DataFrame:
    """Scan the monthly files of one dataset.

    Missing months are skipped and the scan goes on with the rest; it fails
    with FileNotFoundError only if none is left (S3). Each month is read with
    the schema of its own footer and cast to one schema -- ``schema``, or the
    common type of each column -- since the types of a column differ between
    months; a column that a month lacks is NULL there. A file whose footer
    cannot be read fails the scan, unless a list ``unreadable`` is given:
    then it is skipped, and its path is added to the list and logged (S4).
    ``columns`` prunes the scan (S5; Catalyst also prunes any later
    ``select``). ``year_month`` and ``source_dataset`` come from the file name.
    """
    paths = _listed(spark, base, dataset) if months is None else \
        [p for p in month_paths(base, dataset, months) if _fs_exists(spark, p)]
    if not paths:
        raise FileNotFoundError(f"no {dataset} month found under {base}" + (f" for {list(months)}" if months else ""))
    read = []
    for p in paths:
        try:
            read.append((p, spark.read.parquet(p)))
        except Exception as e:
            # Only a file that cannot be opened as parquet is skipped.
            if unreadable is None or not re.search("CANNOT_READ_FILE_FOOTER|not a Parquet file|UNABLE_TO_INFER_SCHEMA|Could not read footer", str(e)):
                raise
            unreadable.append(p)
            _log.warning("skipped unreadable file %s", p)
    if not read:
        raise FileNotFoundError(f"no readable {dataset} month under {base}: {unreadable}")
    names = list(columns or dict.fromkeys(c for _, m in read for c in (schema.fieldNames() if schema else m.columns)))
    kind = {f.name: f.dataType for f in schema.fields} if schema else \
        {c: _common_type([m.schema[c].dataType for _, m in read if c in m.columns]) for c in names
         if any(c in m.columns for _, m in read)}
    missing = [c for c in names if c not in kind]
    if missing:
        raise ValueError(f"scan_trips: no {dataset} month has {missing}")
    # Months of one footer schema are one scan, so the plan stays small.
    alike: dict[str, list[str]] = {}
    schemas = {}
    for p, m in read:
        alike.setdefault(m.schema.json(), []).append(p)
        schemas[m.schema.json()] = m.schema
    parts = []
    for key, group in alike.items():
        m = spark.read.schema(schemas[key]).parquet(*group)
        name = F.regexp_replace("_metadata.file_path", "/part-[^/]*$", "")
        parts.append(m.select(*[(F.col(c) if c in m.columns else F.lit(None)).cast(kind[c]).alias(c) for c in names],
                              month_from_path(name).alias("year_month"), dataset_from_path(name).alias("source_dataset")))
    return reduce(DataFrame.unionByName, parts)


def scan_partitioned(spark: SparkSession, base: str, dataset: str | None = None,
                     months: Sequence[str] | None = None) -> DataFrame:
    """Scan a trip table written with ``partitionBy("dataset", "year_month")``
    (S1 for the partitioned layout). The dataset and month filters are
    partition filters: only the matching directories are listed and read; an
    unreadable file fails the read."""
    df = spark.read.parquet(base)
    if dataset is not None:
        df = df.where(F.col("dataset") == dataset)
    if months is not None:
        df = df.where(F.col("year_month").isin(list(months)))
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A processed parquet table."""
    return spark.read.parquet(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension CSV with header and a declared schema."""
    return spark.read.csv(path, header=True, schema=ZONES)


def read_first_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first existing table of a preference list, e.g. combined, else
    yellow-only (S10)."""
    for p in paths:
        if _fs_exists(spark, p):
            return read_table(spark, p)
    raise FileNotFoundError(f"none of {list(paths)} exists")
