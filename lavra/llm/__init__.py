"""Operators for building training data: storage, scans, joins, filters and packing."""
