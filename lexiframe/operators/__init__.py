"""Corpus operators as DataFrame transformations (lazy; no collect on data paths)."""
