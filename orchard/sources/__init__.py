"""Readers, writers and small table constructors."""

from orchard.sources.tables import (  # noqa: F401
    TABLES, read_table, read_labelled_csv, read_headerless, parse_delimited,
    row_count, table_counts, shape, zip_columns, report, param_grid,
)
