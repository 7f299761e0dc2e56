"""The registered queries: each operator on the given tables, next to the SQL that checks it."""

from registered import inputs, keyed, loads, scalars, storage  # noqa: F401  (they register themselves)
from registered.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
