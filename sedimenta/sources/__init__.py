"""Readers, table formats and the entity views over the source tables."""
