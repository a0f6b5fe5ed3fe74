"""DataFrame -> DataFrame operators, grouped by the reference's categories."""
