"""Sinks: versioned publishing, catalog tables, exports."""
