"""Dense-vector operators on ``array<float|double>`` columns, all built from
higher-order functions (JVM side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.functions.text import _c


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL when either side is NULL or has zero norm."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def normalize(v) -> Column:
    """L2-normalised copy (a zero vector stays zero)."""
    n = norm(v)
    return F.transform(as_double(v), lambda x: F.when(n > 0, x / n).otherwise(x))


def check_dimension(v, dim: int) -> Column:
    return F.size(_c(v)) == dim


def mean_vector(df: DataFrame, key: str, vec: str, weight: str | None = None) -> DataFrame:
    """Element-wise mean of ``vec`` per ``key`` (each row counts once, or ``weight`` times).

    Exploded by position, averaged by (key, position) with partial
    aggregation, then reassembled in position order; the per-key array is
    bounded by the vector dimension."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    ex = df.select(key, w.alias("w"), F.posexplode(as_double(vec)).alias("pos", "x"))
    per = ex.groupBy(key, "pos").agg((F.sum(F.col("x") * F.col("w")) / F.sum(F.when(F.col("x").isNotNull(), F.col("w")))).alias("x"))
    return per.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(vec)
    )
