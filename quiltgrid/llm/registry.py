"""The queries of this subpackage, by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

MODULES = {
    "op1_language_id": "op1_language_id",
    "op2_mixing": "op2_mixing",
    "op3_decontamination": "op3_decontamination",
    "op4_url_filter": "op4_url_filter",
    "op5_quality_rules": "op5_quality_rules",
    "op6_sharding": "op6_sharding",
    "op7_warc": "op7_warc",
    "op8_token_output": "op8_token_output",
    "op9_line_dedup": "op9_line_dedup",
    "op10_simhash": "op10_simhash",
    "op11_exact_dedup": "op11_exact_dedup",
    "op12_merkle_manifest": "op12_merkle_manifest",
    "op13_periodic_runs": "op13_periodic_runs",
}


def queries() -> dict:
    return {name: getattr(import_module(f"quiltgrid.llm.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"quiltgrid.llm.{module}"), "ORACLE_SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
