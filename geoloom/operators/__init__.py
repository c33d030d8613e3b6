"""Joins, aggregates, windows, generators and regions."""
