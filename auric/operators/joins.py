"""Join helpers with an explicit broadcast policy.

A side is broadcast only when its size is bounded: either by the domain (a
fixed lookup list) or by Catalyst's size estimate of the optimized plan,
checked here against a limit. Above the limit the plain join is returned and
Spark picks a shuffle join; AQE may still convert it at runtime from real
shuffle sizes, and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# of compressed files, which grow ten to twenty times in memory
BROADCAST_LIMIT_BYTES = 2 * 1024 * 1024
# of files of nothing but ids and dates, which grow two to three times
KEYS_LIMIT_BYTES = 8 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df`` (file sizes for scans, propagated
    through projections and filters). No job is run."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # estimate unavailable: treat as large
        return 1 << 62
    # py4j hands a BigInt over as a Python int; older bridges as a JVM object
    return size if isinstance(size, int) else int(size.toString())


def delivered_bytes(df: DataFrame) -> int:
    """Size of the files that the rows of ``df`` come from, without what was joined to them from the right: a join's own
    estimate is the product of its sides."""
    def size(plan):
        sides = plan.children()
        if sides.isEmpty():
            n = plan.stats().sizeInBytes()
            return n if isinstance(n, int) else int(n.toString())
        return sum(size(sides.apply(i)) for i in range(1 if plan.nodeName() == "Join" else sides.size()))

    try:
        return size(df._jdf.queryExecution().optimizedPlan())
    except Exception:  # as above
        return 1 << 62


def bounded(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is under ``limit``, else ``df``."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
             limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Fact-to-dimension join; the dimension is broadcast only behind the size check."""
    return fact.join(bounded(dim, limit), on, how)
