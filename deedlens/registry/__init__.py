"""Registered queries over the stand-in tables, each beside its SQL.

A query takes the session and the folder of the tables. Every one reads whole
tables. Queries without SQL are model fits.
"""

from __future__ import annotations

import importlib

from deedlens.registry.base import QUERIES, SQL

_MODULES = ("reports", "labels", "profiles", "samples", "scalars", "features", "messages", "sources")

for _name in _MODULES:
    importlib.import_module(f"deedlens.registry.{_name}")

__all__ = ["QUERIES", "SQL"]
