"""Registered queries over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from tributary.plans.catalogue import (  # noqa: F401
    cleaning,
    flows,
    grouping,
    quality,
    scans,
    star,
    text,
    typing,
)
from tributary.plans.catalogue.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
