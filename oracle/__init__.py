"""The same queries as plain SQL for DuckDB, over the supplied tables, written from the definitions."""

from __future__ import annotations

import re

from oracle.inputs import INPUTS
from oracle.layers import LAYERS

TABLES: dict[str, str] = {**INPUTS, **LAYERS}


def complete(query: str) -> str:
    """Put in front of a query the named tables it uses, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", text):
            if name in TABLES and name not in needed and TABLES[name] is not text:
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    named = ",\n".join(f"{name} AS ({TABLES[name]})" for name in needed)
    return f"WITH {named}\n{query}" if named else query


def build() -> dict[str, str]:
    from oracle import beyond, queries

    return {name: complete(text) for name, text in (queries.QUERIES | beyond.QUERIES).items()}
