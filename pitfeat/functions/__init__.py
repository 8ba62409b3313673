"""Aggregate registry and scalar Column helpers."""
