"""Registered queries against their DuckDB SQL on the smallest fixture.

Set ZONECAST_FULL_ORACLE=1 to run every SQL-checked query.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest, norm  # noqa: E402

from fixture_paths import SF001  # noqa: E402

QUICK = ["zone_hour_features", "clean_report", "zone_hour_totals", "holiday_calendar", "metrics_by_zone",
         "metrics_by_decile", "error_percentiles", "future_features", "daily_forecast_error", "weekday_counts",
         "residual_normality", "sample_predictions", "scalar_calendar", "month_selection",
         "combined_features", "source_roundtrip", "clamped_predictions"]
NAMES = sorted(E.oracle_sql()) if os.environ.get("ZONECAST_FULL_ORACLE") else QUICK


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF001).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert digest(norm(s)) == digest(norm(d))


def test_every_query_has_a_callable_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0 and "rolling_mean_168h" in df.columns
