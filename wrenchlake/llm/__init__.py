"""Operators for preparing training text: packing, fingerprints, private data, search, archives, duplicates, scoring."""
