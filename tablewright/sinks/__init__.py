"""Sinks: normalized CSV, catalog tables, relationship metadata."""
