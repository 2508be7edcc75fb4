"""Readers and writers: the lake zones, the event log and the warehouse."""
