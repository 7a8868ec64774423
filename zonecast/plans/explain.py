"""Plan inspection helpers for tests and tuning."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (what ``df.explain(mode)`` prints)."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def count_nodes(df: DataFrame, name: str) -> int:
    """How many times an operator name occurs in the formatted plan header."""
    head = plan_text(df).split("\n\n")[0]
    return head.count(name)
