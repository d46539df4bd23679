"""Readers and the writers that feed them."""
