"""Operators for training-data corpora: deduplication, classifiers, sharding, extraction, tokenisation, scans."""
