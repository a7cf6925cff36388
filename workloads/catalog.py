"""All registered queries."""

from . import delivering, reading, triggering  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
