"""Writing bars, exports and reports."""
