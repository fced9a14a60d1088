"""Readers and writers. Paths are the caller's; nothing here has a default location."""
