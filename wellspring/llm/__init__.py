"""Operators for building training data from text at scale."""
