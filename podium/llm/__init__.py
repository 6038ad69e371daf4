"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it.  ``QUERIES`` and ``ORACLES`` hold the
``opN_<name>`` queries and, where SQL can express them, their DuckDB SQL.
"""

from __future__ import annotations

from podium.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
