"""Operators for preparing training data: search, tokens, mixing, archives, duplicates, classifiers.

Nothing outside this package imports it. Each module holds one operator with its
own interface; ``queries`` registers the thin queries and their SQL.
"""
