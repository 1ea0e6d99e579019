"""Importing this package registers every query."""

from importlib import import_module

MODULES = ["core", "signals", "blocks", "integrity", "structure", "linkage", "graph"]
for _m in MODULES:
    import_module(f"lexanchor.plans.{_m}")
