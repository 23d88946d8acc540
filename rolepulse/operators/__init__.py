"""Relational building blocks used by the jobs."""
