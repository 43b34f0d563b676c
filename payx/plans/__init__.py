"""Whole rebuilds and publication."""
