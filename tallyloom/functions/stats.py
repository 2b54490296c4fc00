"""Statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The published rational approximation 7.1.26 of the error function.
ERF_P, ERF_A = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x: Column) -> Column:
    """Within 1.5e-7."""
    t = 1 / (1 + ERF_P * F.abs(x))
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + a) * t
    return F.signum(x) * (1 - poly * F.exp(-x * x))


def two_sided_p(z: Column) -> Column:
    """The chance of a standard normal at least as far from 0."""
    return 1 - erf(F.abs(z) / F.sqrt(F.lit(2.0)))


def two_proportion_z(hits_a: Column, n_a: Column, hits_b: Column, n_b: Column) -> Column:
    """The pooled z statistic; null where a base is 0 or the pooled share is 0 or 1."""
    pooled = F.try_divide(hits_a + hits_b, n_a + n_b)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n_a) + F.try_divide(F.lit(1.0), n_b)))
    return F.try_divide(F.try_divide(hits_a, n_a) - F.try_divide(hits_b, n_b), spread)


def share(part: Column, whole: Column) -> Column:
    """part / whole; null for a whole of 0."""
    return F.try_divide(part, whole)
