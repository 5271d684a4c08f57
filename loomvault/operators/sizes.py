"""What Catalyst knows of a frame's size before anything runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config

MOST_PARTS = 1 << 14
UNKNOWN = 1 << 60  # what Catalyst says of rows it knows nothing about is beyond this


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a frame, None where the session cannot tell."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # no JVM handle on a remote session
        return None


def scanned_bytes(df: DataFrame) -> int | None:
    """Size of the stored data a frame is computed from: join estimates multiply, this does not."""
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()  # known without optimizing the plan
        return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    except Exception:
        return None


def parts_for(df: DataFrame, each: int) -> int | None:
    """Number of partitions for rows computed from stored data, one for each ``each`` bytes of it; None where the size is not known.

    Exchanged text is merged by its compressed size into partitions whose sorts and hash tables are many times that: with a number
    that grows with the scan they stay as they are, at every size.
    """
    size = scanned_bytes(df)
    if size is None or size > UNKNOWN:
        return None
    return min(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // each)), MOST_PARTS)


def dealt(df: DataFrame, each: int, *keys: str) -> DataFrame:
    """Rows exchanged by their keys into ``parts_for`` partitions."""
    parts = parts_for(df, each)
    return df.repartition(*keys) if parts is None else df.repartition(parts, *keys)


def fits_broadcast(df: DataFrame, limit: int = config.BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def broadcast_if_small(df: DataFrame, limit: int = config.BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side whose estimated size is below the limit."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df
