"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

import importlib

MODULES = [
    "leadforge.plans.q_pages",
    "leadforge.plans.q_documents",
    "leadforge.plans.q_directory",
    "leadforge.plans.q_contacts",
    "leadforge.plans.q_audit",
    "leadforge.plans.q_streaming",
]


def _merge(attr: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(getattr(importlib.import_module(m), attr))
    return out


def queries() -> dict:
    return _merge("QUERIES")


def oracles() -> dict:
    return _merge("ORACLES")
