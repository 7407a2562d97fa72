"""Readers and writers: raw batches, typed tables, references."""
