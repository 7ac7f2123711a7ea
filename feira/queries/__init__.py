"""Every operator as a named query over the domain tables."""

import importlib
import pkgutil

from feira.queries.registry import oracle_sql, queries

_SUPPORT = {"registry", "views"}
for _module in pkgutil.iter_modules(__path__):
    if _module.name not in _SUPPORT:
        importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["oracle_sql", "queries"]
