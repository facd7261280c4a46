"""Named queries over the given tables, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from importlib import import_module

GROUPS = ("aggregates", "columns", "compat", "lookups", "tables", "windows")


def queries() -> dict:
    out: dict = {}
    for group in GROUPS:
        out |= import_module(f"quiltgrid.plans.{group}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in GROUPS:
        out |= import_module(f"quiltgrid.plans.{group}").ORACLES
    return out
