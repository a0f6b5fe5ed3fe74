"""Scalar column functions (N1-N9) and numeric helpers.

All of them are plain Catalyst expressions.  Each takes column names or
Columns and returns a Column, so they compose inside ``select``/``where``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from orchard.functions.vectors import euclidean  # N1, re-exported

__all__ = [
    "euclidean", "parse_int_or_zero", "parse_double_or_zero", "int_list",
    "clamp_gamma", "floor_epsilon", "dataset_id", "format_pct", "linspace",
    "parity_expected", "log_factorial", "choose2",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Integer / double parse that never fails: bad text becomes 0.
def parse_int_or_zero(c) -> Column:
    return F.coalesce(_col(c).try_cast("int"), F.lit(0))


def parse_double_or_zero(c) -> Column:
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


# N4: "3,0,x,7" -> [3, d, d, 7]: tokens that are not positive integers take d.
def int_list(c, default: int) -> Column:
    def one(tok):
        v = tok.try_cast("int")
        return F.when(v > 0, v).otherwise(F.lit(default))
    return F.transform(F.split(_col(c), ","), one)


# A discount factor must lie in [0, 1): >= 1 becomes .99, < 0 becomes 0.
def clamp_gamma(c) -> Column:
    g = _col(c).cast("double")
    return F.when(g >= 1.0, F.lit(0.99)).when(g < 0.0, F.lit(0.0)).otherwise(g)


# Exploration rate never below .01.
def floor_epsilon(c) -> Column:
    return F.greatest(_col(c).cast("double"), F.lit(0.01))


# Data-set id of a path: last '/' segment, text before the first '_'.
def dataset_id(c) -> Column:
    last = F.element_at(F.split(_col(c), "/"), -1)
    return F.split_part(last, F.lit("_"), F.lit(1))


# Printf-style percentage, e.g. 0.12345 -> " 12.345".
def format_pct(c, fmt: str = "%6.3f") -> Column:
    return F.format_string(fmt, _col(c).cast("double") * F.lit(100.0))


# N evenly spaced values from start to stop (both included).
def linspace(start, stop, n) -> Column:
    s, e, k = _col(start).cast("double"), _col(stop).cast("double"), _col(n)
    return F.transform(
        F.sequence(F.lit(0), k - 1),
        lambda i: F.when(k == 1, s).otherwise(s + i.cast("double") * (e - s) / (k - 1).cast("double")),
    )


# The value expected at position i of an alternating pattern that starts
# with ``first``.
def parity_expected(first, i) -> Column:
    f = _col(first)
    return F.when(_col(i) % 2 == 0, f).otherwise(F.lit(1) - f)


def choose2(c) -> Column:
    """n choose 2 as a double (pair counts overflow ``bigint`` at scale)."""
    n = _col(c).cast("double")
    return n * (n - F.lit(1.0)) / F.lit(2.0)


# ln(m!) for m = 0..19 from the Python standard library; above that Stirling's
# series with four correction terms (absolute error below 1e-13).
_SMALL_LOG_FACT = [math.lgamma(m + 1) for m in range(20)]


def log_factorial(c) -> Column:
    """ln(m!) as a JVM expression (Spark SQL has no ``lgamma``)."""
    m = _col(c).cast("double")
    x = m + F.lit(1.0)
    stirling = ((x - 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi))
                + F.lit(1.0) / (F.lit(12.0) * x)
                - F.lit(1.0) / (F.lit(360.0) * F.pow(x, 3))
                + F.lit(1.0) / (F.lit(1260.0) * F.pow(x, 5))
                - F.lit(1.0) / (F.lit(1680.0) * F.pow(x, 7)))
    table = F.array(*[F.lit(v) for v in _SMALL_LOG_FACT])
    return F.when(m < 20, F.element_at(table, m.cast("int") + 1)).otherwise(stirling)
