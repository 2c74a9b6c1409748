"""All registered queries."""

import importlib

from starloom.plans.registry import QUERIES as ALL

for _module in ("models", "reports", "storage", "loads", "quality", "lineage", "streams"):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ALL"]
