"""Structured Streaming forms of operators that need no state."""
