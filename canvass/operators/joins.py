"""Join helpers: broadcast of small tables behind a check of their size in bytes."""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``'s rows, from metadata alone: no job runs.

    For a stored table this is the bytes of its files, scaled to the columns
    read; a filter keeps its input's size, a union adds its inputs, and a join
    multiplies them, so an unstored join counts as large.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bytes_at_most(df: DataFrame, max_bytes: int) -> bool:
    """Whether ``df`` surely has at most ``max_bytes``; False where the optimizer cannot be asked (Spark Connect)."""
    try:
        return size_in_bytes(df) <= max_bytes
    except (AttributeError, PySparkAttributeError):
        return False


def dimension(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast a small table only behind a checked size bound.

    A table of at most ``max_bytes`` (:func:`size_in_bytes`) is hinted for a
    broadcast hash join: no shuffle of the large side.  A larger one is
    returned unhinted, so the planner picks a shuffle join, which AQE may
    still turn into a broadcast from the real shuffle size.
    """
    return F.broadcast(df) if bytes_at_most(df, max_bytes) else df
