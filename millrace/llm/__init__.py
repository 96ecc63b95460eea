"""Operators for preparing large text corpora.

Each module holds one operator; ``queries`` applies them to the given tables.
"""
