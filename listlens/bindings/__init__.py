"""Operators bound to the driver tables."""

import importlib

from listlens.bindings.registry import ORACLES as ALL_ORACLES
from listlens.bindings.registry import QUERIES as ALL_QUERIES

for _name in ("profile", "features", "text", "training"):
    importlib.import_module(f"listlens.bindings.{_name}")

__all__ = ["ALL_ORACLES", "ALL_QUERIES"]
