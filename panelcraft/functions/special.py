"""Tail probabilities as plain column expressions, so that tests stay inside the JVM."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_SERIES_TERMS = 150
_ERFC_ZERO = 6.0
#: From this many degrees of freedom on the tail is an integral over NODES points; below it a sum of at most half as many terms.
LARGE_DOF, NODES = 200, 64


def _running(start: Column, total: Column, last: Column, ratio) -> Column:
    """total + sum of terms, each term being the one before times ``ratio(i)`` for i = 1..last."""
    steps = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    seed = F.struct(start.alias("term"), total.alias("total"))

    def add(acc, i):
        term = acc["term"] * ratio(i)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(steps, seed, add, lambda acc: acc["total"])


def _log_sum(first: Column, last: Column, log_ratio) -> Column:
    """log of a sum of terms: exp(first), then each term exp(log_ratio(i)) times the one before, i = 1..last.

    Kept in logarithms, so that a sum whose first terms are below the smallest double is still right."""
    steps = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    seed = F.struct(first.alias("term"), first.alias("total"))

    def add(acc, i):
        term = acc["term"] + log_ratio(i)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    return F.aggregate(steps, seed, add, lambda acc: acc["total"])


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0, absolute error near 1e-15; 0 beyond z = 6."""
    z = z.cast("double")
    series = _running(z, z, F.lit(_SERIES_TERMS), lambda i: 2.0 * z * z / (2 * i + 1))
    value = 1.0 - 2.0 / math.sqrt(math.pi) * F.exp(-z * z) * series
    return F.when(z >= _ERFC_ZERO, F.lit(0.0)).otherwise(F.greatest(value, F.lit(0.0)))


def _large_tail(h: Column, dof: Column) -> Column:
    """Upper tail for many degrees of freedom, in a bounded number of steps.

    The density t^b exp(-t), b = dof / 2 - 1, has its peak at b and a width of sqrt(b). Gauss-Legendre points cover the part of
    the tail that is above rounding, on the side of h away from the peak. All is taken relative to the peak, whose height comes
    from Stirling's series, so that nothing large cancels.
    """
    b = dof / 2.0 - 1.0
    width = F.sqrt(b)
    upper = h > b
    far = F.when(upper, F.greatest(b + 11.5 * width, h + 6.0 * width)).otherwise(
        F.greatest(F.lit(0.0), F.least(b - 7.5 * width, h - 5.0 * width)))
    points, weights = np.polynomial.legendre.leggauss(NODES)
    table = F.array(*[F.struct(F.lit(float(0.5 * (x + 1))).alias("x"), F.lit(float(0.5 * w)).alias("w"))
                      for x, w in zip(points, weights)])

    def add(acc, node):
        u = (h + (far - h) * node["x"] - b) / b
        return acc + node["w"] * F.when(u > -1, F.exp(b * (F.log1p(u) - u))).otherwise(0.0)

    peak = F.exp(-0.5 * F.log(2 * math.pi * b) - 1 / (12 * b) + 1 / (360 * b * b * b))
    part = F.abs(far - h) * peak * F.aggregate(table, F.lit(0.0), add)
    return F.when(upper, part).otherwise(1.0 - part)


def chi2_upper_tail(stat: Column, dof: Column) -> Column:
    """P(X >= stat) for a chi-squared variable: finite sums for both parities of a small ``dof``, an integral for a large one."""
    h = stat.cast("double") / 2.0
    large = dof.cast("double") >= LARGE_DOF
    many = _large_tail(h, F.when(large, dof.cast("double")))
    dof = F.when(~large, dof.cast("int"))
    log_h = F.log(h)
    even = F.exp(_log_sum(-h, (dof / 2).cast("int") - 1, lambda i: log_h - F.log(i.cast("double"))))
    first = -h + log_h / 2 + math.log(2.0 / math.sqrt(math.pi))
    odd_one = erfc(F.sqrt(h))
    odd_more = odd_one + F.exp(_log_sum(first, ((dof - 1) / 2).cast("int") - 1, lambda i: log_h - F.log(i + 0.5)))
    return (F.when(stat.isNull(), F.lit(1.0))
            .when(large & (stat > 0), F.greatest(F.least(many, F.lit(1.0)), F.lit(0.0)))
            .when((dof <= 0) | (stat <= 0), F.lit(1.0))
            .when(dof % 2 == 0, F.least(even, F.lit(1.0)))
            .when(dof == 1, odd_one)
            .otherwise(F.least(odd_more, F.lit(1.0))))


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|), which equals the upper tail of z squared with one degree of freedom."""
    return erfc(F.abs(z) / math.sqrt(2.0))
