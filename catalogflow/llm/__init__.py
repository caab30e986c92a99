"""Operators for preparing training text: mixing, packing, scans, near duplicates, classifiers, search."""
