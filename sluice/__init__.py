"""Conversion-funnel analytics as DataFrame operators."""
