"""Readers: topics, rate files, relational tables, SQL files."""
