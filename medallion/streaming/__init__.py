"""Streaming targets and flows."""
