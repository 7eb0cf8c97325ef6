"""Readers, sinks and the run history."""
