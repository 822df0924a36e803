"""Structured Streaming drivers over the feed folder."""
