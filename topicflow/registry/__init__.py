"""Named queries over the given tables, and the SQL that checks them."""

from . import corpus, lifecycle, model  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
