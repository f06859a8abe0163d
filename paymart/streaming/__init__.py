"""The message stream: decode, dedup, continuous upsert."""
