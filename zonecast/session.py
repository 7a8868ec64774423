"""Session helpers: configuration and fault-tolerant materialisation."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: naive timestamps are compared in UTC, AQE
# re-plans joins and coalesces shuffle partitions at run time, and parquet
# keeps its vectorised reader.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    # A side hash-partitioned by zone satisfies a join on (zone, hour): the
    # grid join and the per-zone window then share one partitioning.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`DEFAULT_CONF` to a session of our own."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


_own: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def own_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, on the same context, with the caller's
    SQL settings and :data:`DEFAULT_CONF` on top. Planner settings and time
    zone then hold for our queries and leave the caller's session as it is."""
    if all(spark.conf.get(k, None) == v for k, v in DEFAULT_CONF.items()):
        return spark
    own = _own.get(spark)
    if own is None:
        own = _own[spark] = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k) and own.conf.get(k, None) != v:
            own.conf.set(k, v)
    return configure(own)


def get_session(master: str | None = None, app_name: str = "zonecast",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Create or fetch a session with :data:`DEFAULT_CONF` applied.

    On a cluster ``master`` stays ``None`` (spark-submit decides); tests pass
    ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return configure(b.getOrCreate())


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` (or a directory already set on the context) wins.
    Only when neither is set -- tests on ``local[N]`` -- is ``fallback`` or a
    fresh temporary folder used; on a cluster an unset directory is an error
    because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if fallback is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before materialising")
        fallback = tempfile.mkdtemp(prefix="zonecast-ckpt-")
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir() or fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, removed with the driver."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/zonecast-{name}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet in the shared checkpoint folder and read
    it back.

    Used where one expensive table feeds several branches or an iterative
    fit: a lost executor re-reads the files instead of recomputing the plan
    from the raw scan, and later reads prune columns and use the vectorised
    reader.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
