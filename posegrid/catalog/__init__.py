"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ("captures", "paths", "graphs", "meshes", "outputs", "documents")


def load_catalog():
    """All queries and their SQL twins."""
    from posegrid.catalog import register
    for name in MODULES:
        importlib.import_module(f"posegrid.catalog.{name}")
    return dict(register.QUERIES), dict(register.ORACLE)
