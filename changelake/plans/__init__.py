"""Registered queries and the fixtures they derive from the given tables."""
