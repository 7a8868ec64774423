"""Monthly trip files as a stream (S1 + S6/S7 + A2/A3 run incrementally).

The reference aggregates each monthly file to zone-hour totals as it is
downloaded and re-sums the per-file totals at the end. Totals are additive,
so the stream writes one partial table per micro-batch and
:func:`read_ingested` re-sums them (A3). Each batch overwrites its own
``dataset=D/batch_id=N`` folder, so a batch replayed after a failure replaces its
earlier output instead of doubling it; the stream's progress lives in its
checkpoint location, which must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zonecast.operators.zonehour import combine_sources, normalize_trips, totals_zone_hour
from zonecast.schema import TripCols


def ingest_trip_files(spark: SparkSession, source_dir: str, dataset: str, schema: T.StructType | str,
                      sink_dir: str, checkpoint_location: str, cols: TripCols = TripCols(),
                      files_per_batch: int = 1000, available_now: bool = True) -> StreamingQuery:
    """Start a file stream over ``source_dir``; the trips of the new files,
    up to ``files_per_batch`` together, are normalised and reduced to
    zone-hour totals in one micro-batch."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(source_dir))
    norm = normalize_trips(stream, dataset, cols)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (totals_zone_hour(batch)
         .write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/dataset={dataset}/batch_id={batch_id}"))

    w = norm.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_ingested(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Re-sum the per-batch totals of every dataset into the combined
    zone-hour table (A3)."""
    parts = spark.read.parquet(sink_dir)
    return combine_sources([parts.select("pickup_datetime", "PULocationID", "trip_count",
                                         "total_distance", "total_passengers")])
