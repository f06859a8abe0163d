"""Payments mart on Spark: messages and rates in, a daily turnover mart out."""
