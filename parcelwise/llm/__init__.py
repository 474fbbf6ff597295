"""Operators for large training corpora: tokens, shards, packing, duplicates, filters, scores.

Nothing else in the library imports this folder."""
