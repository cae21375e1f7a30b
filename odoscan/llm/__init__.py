"""Operators for preparing training data: packing, search, scans, near copies, mixing, counting."""
