"""The registered queries: every operator run over the benchmark tables, with its SQL where there is one.

Each module holds ``QUERIES``: name -> (query, SQL or None). A query takes (spark, directory of tables).
"""

from __future__ import annotations

from importlib import import_module

MODULES = ("filters", "reading", "buckets", "children", "places", "fulltext", "changes", "rebuilding", "layouts")


def registry() -> dict:
    out: dict = {}
    for name in MODULES:
        found = import_module(f"quern.plans.{name}").QUERIES
        repeated = out.keys() & found.keys()
        if repeated:
            raise ValueError(f"queries registered twice: {sorted(repeated)}")
        out |= found
    return out
