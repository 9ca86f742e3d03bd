"""All queries of the engine by name, with their SQL where there is any."""
from __future__ import annotations

from importlib import import_module

QUERIES: dict = {}
for _name in ("core", "web", "serving", "candidates", "quality", "text", "lexicon", "io"):
    QUERIES |= import_module(f"murmura.plans.{_name}").QUERIES
