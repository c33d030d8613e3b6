"""Covers, collection, preservation and maps."""
