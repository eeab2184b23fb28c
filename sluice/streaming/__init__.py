"""Continuously kept tables."""
