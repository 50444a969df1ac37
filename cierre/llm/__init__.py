"""Operators of a training-data pipeline: language-model scoring, repeated
passages, exact vector search, near-duplicates, fingerprints, quality and
toxicity classifiers, tokenization, licence scans and sequence packing.

Nothing else in the library imports this subpackage.
"""
