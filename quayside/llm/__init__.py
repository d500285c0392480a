"""Operators for preparing training data: screening, counting, packing, scoring and search."""
