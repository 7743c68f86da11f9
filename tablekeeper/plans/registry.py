"""All registered queries and their SQL, by name."""

from . import dialect, history, reports, routing, tables, temporal, texts, upkeep

_MODULES = (history, tables, reports, texts, dialect, routing, upkeep, temporal)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
