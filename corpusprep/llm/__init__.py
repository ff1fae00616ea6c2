"""Operators for building training data from a large corpus."""
