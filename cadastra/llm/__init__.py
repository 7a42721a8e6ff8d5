"""Operators for large text, vector and image corpora used as training data."""
