"""Operators for building training corpora.

Each module holds one operator with its general interface; ``queries.py``
holds the thin driver-table queries. Nothing else in the library imports
this subpackage.
"""
