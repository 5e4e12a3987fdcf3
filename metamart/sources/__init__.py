"""Scans and sinks: landing files, metadata, bronze, audit, gold."""
