"""Assembled feature marts, serving queries and the query registry."""
