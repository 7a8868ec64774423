"""Presentation of a result for comparison: stable types, rounded doubles.

Integers become ``bigint``, decimals and doubles are rounded to 6 places,
dates become ``yyyy-MM-dd`` strings. Applied only at the edge of a
registered query, never inside the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame, places: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), places)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.BooleanType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
