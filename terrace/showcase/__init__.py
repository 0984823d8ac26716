"""Every operator and model on the analytics tables, each with the SQL it must agree with."""

from . import landing, operators, quality, warehouse  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
