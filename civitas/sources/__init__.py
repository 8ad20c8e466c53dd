"""Readers and writers: archives, dimension files, tables and listings."""
