"""Operators of a training-data pipeline: tokens, packing, secrets, duplicates, quality, fingerprints, language model."""
