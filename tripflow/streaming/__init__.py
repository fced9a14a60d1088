"""Structured Streaming: feed folders in, the ride table out."""
