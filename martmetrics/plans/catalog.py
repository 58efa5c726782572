"""All registered queries: name -> (builder(spark, sf_dir), oracle SQL or None)."""

from __future__ import annotations

from . import month_end, primitives, reports, sheets, snapshot

QUERIES: dict = {}
for _mod in (month_end, reports, snapshot, primitives, sheets):
    QUERIES.update(_mod.QUERIES)
