"""Ratios and smoothing.

ANSI mode is on in Spark 4, so a bare ``/`` raises on a zero denominator.
Every ratio here is built on ``try_divide`` and never raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dbl(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den; NULL when den is 0 or either side is NULL."""
    return F.try_divide(_dbl(num), _dbl(den))


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """num / den; 0.0 when the ratio is undefined."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def ratio_eps(num: Column | str, den: Column | str, eps: float = 1e-5) -> Column:
    """num / (den + eps): finite for a zero denominator."""
    return F.try_divide(_dbl(num), _dbl(den) + F.lit(eps))


def ratio_if_positive(num: Column | str, den: Column | str) -> Column:
    """num / den only where den > 0, NULL elsewhere (negative den included)."""
    return F.when(_dbl(den) > 0, ratio(num, den))


def beta_smoothed(hits: Column | str, trials: Column | str, alpha: float, beta: float) -> Column:
    """Posterior mean of a Beta(alpha, beta) prior."""
    return (F.lit(alpha) + _dbl(hits)) / (F.lit(alpha + beta) + _dbl(trials))


def prior_mean_smoothed(total: Column | str, n: Column | str, mean: float, strength: float) -> Column:
    """Mean pulled to ``mean`` with ``strength`` pseudo-observations."""
    return (F.lit(mean * strength) + _dbl(total)) / (F.lit(strength) + _dbl(n))


def parent_smoothed(hits: Column | str, trials: Column | str, parent_rate: Column, strength: float) -> Column:
    """Rate pulled to the parent's rate; NULL when the parent has no rate."""
    return (_dbl(hits) + F.lit(strength) * parent_rate) / (_dbl(trials) + F.lit(strength))


def stable_mean(value: Column | str) -> Column:
    """Mean whose last digits do not depend on the order of the rows.

    Sums of doubles change with the order in which tasks deliver them. The sum
    is taken in decimals with 8 fraction digits, so a re-run gives equal bits.
    """
    x = F.col(value) if isinstance(value, str) else value
    return F.try_divide(F.sum(x.try_cast("decimal(38,8)")).cast("double"), F.count(x))


def shrunk_rate(rate: Column | str, n: Column | str, parent_rate: Column | str, k: float) -> Column:
    """Weighted mean of own rate (weight n) and parent rate (weight k).

    A missing own rate counts as the parent rate, a missing n stays NULL.
    """
    parent = _dbl(parent_rate)
    return F.try_divide(
        parent * F.lit(float(k)) + F.coalesce(_dbl(rate), parent) * _dbl(n),
        F.lit(float(k)) + _dbl(n),
    )
