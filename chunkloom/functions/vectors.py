"""Column expressions on vectors, in double precision within the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(_double(v), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column) -> Column:
    """Unit length; a vector of zeros stays as it is."""
    n = norm(v)
    return F.transform(_double(v), lambda x: x / F.when(n == 0, F.lit(1.0)).otherwise(n))


def truncate_and_normalize(v: Column, dim: int) -> Column:
    """The first dim entries of a wider vector at unit length; a narrower one is left alone."""
    return F.when(F.size(v) > dim, l2_normalize(F.slice(v, 1, dim))).otherwise(_double(v))


def l2_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""
    return F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def metric(name: str, a: Column, b: Column) -> Column:
    """A score of which greater is nearer."""
    if name == "inner_product":
        return dot(a, b)
    if name in ("l2", "euclidean"):
        return -l2_distance(a, b)
    raise ValueError(f"unknown metric {name!r}")


def reciprocal_gain(rank: Column, k: int) -> Column:
    """Gain at k of the single relevant document at a rank from 0; missing and later ranks gain nothing."""
    return F.when(rank < k, 1.0 / F.log2(rank + 2.0)).otherwise(F.lit(0.0))
