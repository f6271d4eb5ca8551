"""All registered queries with the SQL that checks them.

Each module pairs ``QUERIES`` (name -> function of session and data folder)
with ``ORACLES`` (name -> SQL over the same tables).
"""

from __future__ import annotations

from larkspur.registry import models, recommend, tables, weblog

MODULES = (weblog, tables, models, recommend)


def all_queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
