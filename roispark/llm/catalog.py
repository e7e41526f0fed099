"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from roispark.llm import q_dedup, q_text, q_vectors

_MODULES = [q_dedup, q_text, q_vectors]


def queries() -> dict:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
