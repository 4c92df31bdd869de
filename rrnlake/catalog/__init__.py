"""Registered queries: table bindings, queries and their SQL twins."""
