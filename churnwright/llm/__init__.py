"""Operators for text corpora: near-duplicates, decontamination, sharding, classifiers, personal data, tokens."""
