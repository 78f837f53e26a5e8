"""Operators for building training data at scale. Nothing outside this package imports it."""
