"""Registered queries: the reference's operators over the driver's tables."""

from __future__ import annotations


def registry() -> dict:
    from . import (curated, incremental, landing, landing_files, one_year, reports, scalar, staging,
                   streaming_q, warehouse)
    out = {}
    for mod in (curated, reports, warehouse, scalar, incremental, staging, landing, landing_files,
                one_year, streaming_q):
        out.update(mod.QUERIES)
    return out


def oracles() -> dict:
    from .oracle_sql import ORACLES
    return dict(ORACLES)
