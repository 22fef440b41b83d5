"""Queries over the star-schema tables, one per engine feature, with SQL to check them.

Roles: a file is a customer, a document an order, an item a lineitem, a participant a
customer, a municipality a nation, a period the year of an order.
"""

from __future__ import annotations

from importlib import import_module

MODULES = ("records", "reports", "diagnosis", "subsidy", "tables", "streams")


def catalogue() -> dict:
    """Query name -> (callable, SQL or None)."""
    out: dict = {}
    for name in MODULES:
        out.update(import_module(f"workbench.{name}").QUERIES)
    return out
