"""Operators for preparing large text corpora: fingerprints, filters, deduplication, mixing."""
