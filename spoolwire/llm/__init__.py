"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface, plus the thin
``opN_<name>`` query that applies it to its whole table. ``catalog`` collects
the queries and their oracle SQL. Nothing outside this subpackage imports it.
"""
