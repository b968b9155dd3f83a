"""Readers and writers: monthly trip files, dimensions, views, tables."""
