"""The registered queries with their SQL counterparts over the supplied tables."""

from . import cdc, cleaning, history, io, ml, profiling, relational, silver, star, text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
