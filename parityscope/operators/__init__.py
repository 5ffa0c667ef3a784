"""Table-to-table operators of the audit."""
