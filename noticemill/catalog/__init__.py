"""Queries over the shared test tables, with their SQL."""

from __future__ import annotations

import importlib

_MODULES = ("reporting", "texts", "nesting", "logging", "storing")


def _load():
    from . import registry

    for name in _MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
