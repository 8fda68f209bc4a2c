"""All registered queries. Importing a plan module registers what it defines."""

from __future__ import annotations

import importlib

from mercato.plans.registry import ORACLES, QUERIES

for _name in ("scans", "joins", "gold", "series", "checks", "feeds", "streams", "graphs", "models", "scalars"):
    importlib.import_module(f"mercato.plans.{_name}")

__all__ = ["ORACLES", "QUERIES"]
