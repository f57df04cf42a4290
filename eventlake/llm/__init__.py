"""Operators for training-data pipelines: classifiers, near-duplicates, tokens, packing, sharding."""
