"""Readers and writers: raw files and snapshot-partitioned tables."""
