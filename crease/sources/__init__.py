"""Readers and writers: match documents, ball messages, lake, warehouse, test tables."""
