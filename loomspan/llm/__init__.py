"""Operators for text corpora. Nothing else in the library imports this package."""

MODULES = ("terms", "neardup", "encoding", "frames", "residue", "truncation", "packing", "mixing", "personal")
