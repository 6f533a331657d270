"""Whether a table is small enough to be sent to every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a dimension that may be broadcast.
MOST_ROWS = 50_000


def broadcast_if_small(dimension: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """A dimension with the hint to broadcast it, once it has been counted and is small; a larger one is joined as it is."""
    return F.broadcast(dimension) if dimension.limit(most + 1).count() <= most else dimension
