"""Registered queries: every operator on the driver's tables, with equivalent SQL."""

from . import batch, files, players, quality, snapshots, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
