"""Operators of a training-data pipeline (filters, near-duplicates, tokens,
packing, formatting). Nothing else in the library imports this subpackage."""
