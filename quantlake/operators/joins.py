"""Join helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columnar files are this much larger in memory, at most, in the size estimate below.
FILE_EXPANSION = 4


def broadcast_if_small(df: DataFrame, max_bytes: int | None = 256 << 20) -> DataFrame:
    """Mark ``df`` for broadcast only if its estimated size is at most ``max_bytes``.

    The estimate is the optimizer's (file bytes of the columns read, an upper
    bound through filters and projections, a product through joins) times
    ``FILE_EXPANSION``; nothing is run.  With ``max_bytes=None``, or beyond
    the limit, the choice is left to AQE, which measures the shuffle output.
    """
    if max_bytes is None:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size * FILE_EXPANSION <= max_bytes else df
