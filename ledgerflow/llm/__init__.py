"""Operators for building language-model training data, and their queries."""

from ledgerflow.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
