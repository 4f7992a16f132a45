"""Readers, sinks, ingest, quality checks, audit log and star-schema load."""
