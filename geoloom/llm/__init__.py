"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it; ``geoloom.llm.queries`` lists its
queries and their SQL.
"""
