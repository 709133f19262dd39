"""Scans and parsers of the published file shapes."""
