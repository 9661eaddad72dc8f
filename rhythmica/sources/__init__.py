"""Readers, writers, listings, fingerprints and the feature table cache."""
