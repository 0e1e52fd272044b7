"""The registered queries: each operator over the given tables, with its SQL twin where SQL can say it."""

from tarnwork.queries import aggregates, catalog, columns, joins, loads, products, quality, sources, streams, windows
from tarnwork.queries.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "aggregates", "catalog", "columns", "joins", "loads", "products", "quality", "sources", "streams", "windows",
]
