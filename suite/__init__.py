"""Queries over the given tables, each with the SQL it is checked against."""

from __future__ import annotations

import functools
import importlib

MODULES = ("layers", "dashboard", "quality", "profiles", "ledger", "files")


@functools.cache
def all_queries():
    from suite.registry import Registry

    registry = Registry()
    for name in MODULES:
        importlib.import_module(f"suite.{name}").register(registry)
    return registry
