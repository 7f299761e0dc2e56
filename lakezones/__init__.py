"""Layered data lakes on Spark: landed extracts to raw, refined and curated tables."""

from lakezones.session import prepare_session
from lakezones.specs import TableSpec

__all__ = ["TableSpec", "prepare_session"]
