"""Reference SQL for the registered queries, over the same given tables.

Each statement is assembled from named common table expressions; only the ones a
statement mentions (directly or through another one) are put in front of it.
"""

from __future__ import annotations

import re

from roispark.schema import PIXEL_SIZE_X_UM as PX
from roispark.schema import PIXEL_SIZE_Y_UM as PY

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round(cast({expr} AS double), {digits}) + 0.0 AS {name}"


def cte(name: str, body: str) -> None:
    CTES[name] = body


def statement(body: str) -> str:
    """Prefix ``body`` with the common table expressions it needs, in order."""
    needed: list[str] = []
    open_names: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name in needed or name in open_names or not re.search(rf"\b{name}\b", text):
                continue
            open_names.add(name)
            visit(CTES[name])
            open_names.discard(name)
            needed.append(name)

    visit(body)
    if not needed:
        return body
    # Every dependency is visited before its user, so definition order is valid.
    def one(name: str) -> str:
        loops = re.search(rf"\b{name}\b", CTES[name]) is not None
        return f"{name} AS {'' if loops else 'MATERIALIZED '}({CTES[name]})"

    parts = ", ".join(one(n) for n in needed)
    return f"WITH RECURSIVE {parts} {body}"


def oracle(name: str, body: str) -> None:
    ORACLES[name] = statement(body)
