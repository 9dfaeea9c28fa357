"""Operators of a training-data pipeline: classifiers, tokenizers, secret and
licence scans, similarity search, near-duplicates, decontamination, page text."""
