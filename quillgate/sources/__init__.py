"""Readers and writers: profile CSV, JSON lines, tables, run state."""
