"""Registered queries (one per operator) and the SQL that checks them."""

from __future__ import annotations

import importlib

_QUERY_MODULES = ["q_overlap", "q_objects", "q_identity", "q_masks", "q_stats", "q_fields"]
_ORACLE_MODULES = ["oracle_pixels", "oracle_objects", "oracle_identity", "oracle_masks", "oracle_stats",
                   "oracle_fields"]


def queries() -> dict:
    from roispark.catalog.base import QUERIES
    for name in _QUERY_MODULES:
        importlib.import_module(f"roispark.catalog.{name}")
    return dict(QUERIES)


def oracle_sql() -> dict:
    from roispark.catalog.oracles import ORACLES
    for name in _ORACLE_MODULES:
        importlib.import_module(f"roispark.catalog.{name}")
    return dict(ORACLES)
