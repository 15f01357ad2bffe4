"""Structured Streaming form of the daily arrival (INC-13)."""
