"""Runnable jobs over the engine's operators, and the queries that run them on the whole tables."""
