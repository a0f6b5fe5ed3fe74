"""Composed plans: the registered queries (one per operator of the
inventory), their DuckDB oracle twins, and multi-step experiments."""
