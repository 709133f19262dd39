"""Composite plans: silver tables, views, published queries, quality, sinks."""
