"""Structured Streaming form of the staging load."""
