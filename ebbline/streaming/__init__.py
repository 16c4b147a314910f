"""Incremental intake of crawled files."""
