"""Operators for large-scale training-data pipelines.

Nothing else in ``orchard`` imports this subpackage; it may be deleted as a
whole.  ``queries`` holds the registered queries and their SQL twins.
"""
