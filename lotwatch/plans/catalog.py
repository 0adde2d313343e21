"""All registered queries."""

from __future__ import annotations

from lotwatch.plans import (  # noqa: F401
    q_detect,
    q_ingest,
    q_rootcause,
    q_scenario,
    q_silver,
    q_stream,
    q_text,
)
from lotwatch.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
