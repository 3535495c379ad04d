"""The registered queries, each next to the SQL that states its expected result."""

import importlib

from .base import COVERS, ORACLES, QUERIES

for _area in ("reading", "shaping", "checking", "reusing", "storing", "streams"):
    importlib.import_module(f"{__name__}.{_area}")

__all__ = ["COVERS", "ORACLES", "QUERIES"]
