"""Named queries over the test tables, each with the SQL another engine answers it with."""

import importlib

from orderlens.plans.registry import QUERIES, Query

_MODULES = ["kpi", "exploration", "reporting", "quality", "risk", "forest", "texts", "files"]


def all_queries() -> dict[str, Query]:
    for module in _MODULES:
        importlib.import_module(f"orderlens.plans.{module}")
    return QUERIES
