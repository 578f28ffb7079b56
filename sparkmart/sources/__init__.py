"""Readers, keyed tables and sinks."""
