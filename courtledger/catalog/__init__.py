"""Queries that run the operators on whole tables, each with the SQL it has to agree with."""

from importlib import import_module

MODULES = ("matching", "history", "shapes", "scalars", "pages", "jobs")


def _registered(kind):
    found = {}
    for name in MODULES:
        found.update(getattr(import_module(f"{__name__}.{name}"), kind))
    return found


def all_queries():
    return _registered("QUERIES")


def all_sql():
    return _registered("SQL")
