"""Structured Streaming forms of the collectors and the live marts."""
