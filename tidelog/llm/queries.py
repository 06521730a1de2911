"""Every named query of this folder."""

from __future__ import annotations

from tidelog.llm import queries_arrow, queries_blocks, queries_native  # noqa: F401  (it registers)
from tidelog.llm.registry import ORACLES, QUERIES  # noqa: F401
