"""Structured Streaming jobs of the speed path."""
