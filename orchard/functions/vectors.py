"""Dense-vector expressions over ``ARRAY<DOUBLE>`` columns.

They use Catalyst higher-order functions (``zip_with``, ``aggregate``): the
rows never leave the JVM, though lambdas are interpreted rather than compiled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c) -> Column:
    return _col(c).cast("array<double>")


def vector_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def sq_distance(a, b) -> Column:
    """Squared Euclidean distance, summed left to right over dimensions."""
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)))


def euclidean(a, b) -> Column:
    """Euclidean distance."""
    return F.sqrt(sq_distance(a, b))


def dot(a, b) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: x * y))
