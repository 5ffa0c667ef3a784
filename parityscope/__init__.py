"""Spark-native auditing of classifiers for group bias.

Every public function takes DataFrames and returns DataFrames (or Columns);
nothing runs until the caller acts on the result, apart from sinks and ``fit``.
"""

__version__ = "0.1.0"

from parityscope.roles import AuditRoles, MissingColumnsError, column_report, require_columns

__all__ = ["AuditRoles", "MissingColumnsError", "column_report", "require_columns"]
