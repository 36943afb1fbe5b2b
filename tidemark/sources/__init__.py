"""Readers, lookups, the table store and its sinks."""
