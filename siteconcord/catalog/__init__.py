"""All registered queries."""

import importlib

from siteconcord.catalog.book import ORACLES, QUERIES

for _module in ("inputs", "matching", "scalars", "planning", "dashboards", "streams"):
    importlib.import_module(f"siteconcord.catalog.{_module}")

__all__ = ["ORACLES", "QUERIES"]
