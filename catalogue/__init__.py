"""Queries over the given tables, one per capability, and their SQL counterparts."""
