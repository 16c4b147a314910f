"""Readers, writers and the mapping of given tables to domain tables."""
