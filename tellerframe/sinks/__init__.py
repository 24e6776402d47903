"""Writing: landing files, staged and partitioned tables, loads, exports."""
