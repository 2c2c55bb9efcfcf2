"""Every operator as a query over the shared tables, with SQL to compare.

A module lists entries ``name -> (query, sql)``; ``sql`` is None where the
result cannot be written in SQL. Results use portable column types.
"""

from __future__ import annotations

from terrace.registry import groups, joining, loading, models, rules, scalars, writing

_MODULES = (scalars, joining, groups, writing, rules, loading, models)


def entries() -> dict:
    found: dict = {}
    for module in _MODULES:
        for name, entry in module.ENTRIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found
