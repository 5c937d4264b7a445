"""Readers and writers: delimited text, messages, tables, summary documents."""
