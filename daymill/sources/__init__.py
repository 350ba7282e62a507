"""Readers and writers: day partitions, relational databases, files, schemas."""
