"""Unbiased estimators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pass_at_k(n: Column, c: Column, k: Column) -> Column:
    """Chance that k of n samples, c of them correct, include a correct one.

    NULL when there are fewer than k samples.  The ratio of binomials is a
    product of min(c, k) factors, so nothing overflows and a huge n or c with a
    small k costs k steps only.
    """
    n, c, k = (value.cast("long") for value in (n, c, k))
    few, many = F.least(c, k), F.greatest(c, k)
    factors = F.sequence(F.lit(0).cast("long"), few - 1)
    miss = F.aggregate(
        factors,
        F.lit(1.0),
        lambda product, j: product * (n - many - j) / (n - j),
    )
    return (
        F.when(n < k, F.lit(None).cast("double"))
        .when(c == 0, F.lit(0.0))
        .when(n - c < k, F.lit(1.0))
        .otherwise(1.0 - miss)
    )
