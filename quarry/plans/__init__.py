"""Whole queries: the operators wired to the tables."""

from . import rules
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "rules"]
