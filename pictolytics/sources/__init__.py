"""Readers and writers: paged JSON, one-post-per-line JSON, and the given test tables."""
