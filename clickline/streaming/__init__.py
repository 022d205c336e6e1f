"""Structured Streaming form of the session operator."""
