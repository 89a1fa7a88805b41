"""All named queries; importing the query modules fills the registry."""

from __future__ import annotations

from . import (queries_inference, queries_metrics, queries_reports, queries_segments,  # noqa: F401
               queries_selection)
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
