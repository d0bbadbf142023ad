"""Structured Streaming front end for snapshot landing."""
