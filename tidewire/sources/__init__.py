"""Readers and writers: file lists, archives, raw lines, parsed records, vectors."""
