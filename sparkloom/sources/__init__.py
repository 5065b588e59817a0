"""Readers, sinks and stored specifications."""
