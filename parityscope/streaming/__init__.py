"""Audits of streams."""

from parityscope.streaming.bias_stream import latest_cells, late_rows, start_audit_stream, window_cells

__all__ = ["latest_cells", "late_rows", "start_audit_stream", "window_cells"]
