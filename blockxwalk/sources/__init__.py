"""Readers, sinks and test-table recipes."""
