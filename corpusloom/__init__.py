"""Spark jobs for building and auditing large corpora of web documents."""
