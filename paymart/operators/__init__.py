"""Filters, joins, aggregates, dedup, upserts and checks: frame in, frame out."""
