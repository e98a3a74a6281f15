"""Readers for station lists, observation files and stored tables."""
