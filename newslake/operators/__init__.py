"""Relational building blocks: dedup, latest-wins, top-N, keyed upsert, language."""
