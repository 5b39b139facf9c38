"""Registered queries with their SQL twins, on inputs derived from the driver tables."""

from . import files, records, retrieval, runs, vectors

MODULES = [records, files, vectors, runs, retrieval]
