"""Feeds, tables and lookups."""
