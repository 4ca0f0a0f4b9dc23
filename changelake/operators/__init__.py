"""Batch operators (each also runs unchanged inside a micro-batch)."""
