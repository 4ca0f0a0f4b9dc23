"""Streaming forms of the operators (Structured Streaming, checkpointed)."""
