"""Inputs: raw batches, fact and reference tables."""
