"""Structured Streaming form of the update job."""
