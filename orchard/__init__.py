"""orchard: applied machine-learning table operators on Spark.

Every public operator takes DataFrames (and plain parameters) and returns a
DataFrame.  The heavy lifting is always a Spark plan: scans, projections,
aggregates, joins and windows that Catalyst can optimise.  Python on the
driver only handles bounded things (a model's centres, a d x d matrix, a
handful of scalars).
"""

from orchard.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
