"""Ordered-event, join, upsert and maintenance operators."""
