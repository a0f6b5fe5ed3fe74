"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from orchard.functions.hashing import hash_bucket, hash_rank_key  # noqa: F401
from orchard.functions.vectors import (  # noqa: F401
    as_double_array, sq_distance, euclidean, dot, vector_literal,
)
