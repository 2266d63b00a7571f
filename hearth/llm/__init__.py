"""Operators of a training-data pipeline. Nothing else in the library imports this."""

from hearth.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
