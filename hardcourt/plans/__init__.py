"""Registered queries over the given tables; importing this package registers them all."""

from hardcourt.plans import derivation, events, maintenance, plays, scalars  # noqa: F401
from hardcourt.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
