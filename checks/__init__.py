"""Registered queries: each operator on stand-in tables, with the same query in SQL."""
