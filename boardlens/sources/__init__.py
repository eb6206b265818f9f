"""Readers and writers: tables, CSV, run lists, HTML tables."""
