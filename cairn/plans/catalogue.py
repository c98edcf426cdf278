"""Every query of the library by name, with the SQL that it must match."""

from __future__ import annotations

from . import alignment, anchoring, curation, joins, scalars, summaries  # noqa: F401
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict:
    return dict(ORACLES)
