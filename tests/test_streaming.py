from pyspark.sql import functions as F

import __spark_entry__ as E

from fixture_paths import SF001


def test_stream_ingest_equals_batch_totals(spark):
    qs = E.queries()
    s = qs["streaming_combined_demand"](spark, SF001)
    b = qs["combined_demand"](spark, SF001)
    cols = ["pickup_datetime", "PULocationID", "trip_count", "total_distance", "total_passengers"]
    assert s.count() == b.count()
    assert s.select(cols).exceptAll(b.select(cols)).count() == 0
    assert s.agg(F.sum("trip_count")).first()[0] == b.agg(F.sum("trip_count")).first()[0]
