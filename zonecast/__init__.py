"""zonecast: Spark-native demand analytics for trip-like event tables.

Every public operator takes and returns DataFrames. Column names are
parameters (see :mod:`zonecast.schema`), so the same operators run on the
taxi schema and on any other trip-shaped table.
"""

from zonecast.schema import FEATURES, PanelCols, TripCols  # noqa: F401
from zonecast.session import get_session, materialize  # noqa: F401

__all__ = ["FEATURES", "PanelCols", "TripCols", "get_session", "materialize"]
