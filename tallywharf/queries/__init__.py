"""The registered queries: the library run over the driver's tables, and the same in SQL."""

from .oracles import ORACLES
from .registry import QUERIES

__all__ = ["QUERIES", "ORACLES"]
