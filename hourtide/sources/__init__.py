"""Readers, sinks, derived input views and stage tables."""
