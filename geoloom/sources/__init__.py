"""Scans, connectors and sinks."""
