"""Collects the queries of every plan module and their oracle SQL."""

from __future__ import annotations

import importlib

#: Modules that hold a QUERIES dict and an ORACLE dict.
MODULES = ("federated", "quality", "preparation", "model", "tensors", "extras", "imaging", "checks", "roundtrips")


def all_queries() -> dict:
    """Query name -> callable(spark, sf_dir)."""
    found: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"caresieve.plans.{name}")
        clash = found.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"queries registered twice: {sorted(clash)}")
        found |= module.QUERIES
    return found


def all_oracles() -> dict:
    """Query name -> SQL, for the queries that SQL can express."""
    found: dict = {}
    for name in MODULES:
        found |= importlib.import_module(f"caresieve.plans.{name}").ORACLE
    return found
