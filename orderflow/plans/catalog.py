"""All registered driver-table queries and their SQL oracles."""

from __future__ import annotations

import importlib

from orderflow.plans.registry import ORACLES, QUERIES

MODULES = ["q_orders", "q_changes", "q_lifecycle", "q_tracking", "q_calendar", "q_sources"]

for _m in MODULES:
    importlib.import_module(f"orderflow.plans.{_m}")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
