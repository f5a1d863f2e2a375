"""Queries over the driver tables, each with its DuckDB oracle SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["sorting", "vectors", "lease", "lines", "gradebook", "records", "streams"]


def all_queries():
    out = {}
    for m in _MODULES:
        out.update(import_module(f"{__name__}.{m}").QUERIES)
    return out


def all_sql():
    out = {}
    for m in _MODULES:
        out.update(import_module(f"{__name__}.{m}").SQL)
    return out
