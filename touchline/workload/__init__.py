"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ("q_sources", "q_staging", "q_aggregates", "q_windows", "q_scoring", "q_markets", "q_marts", "q_quality", "q_streams")


def all_queries():
    from touchline.workload.registry import REGISTRY

    for m in MODULES:
        importlib.import_module(f"touchline.workload.{m}")
    return dict(REGISTRY)
