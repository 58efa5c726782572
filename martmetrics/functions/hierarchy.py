"""Business-hierarchy tagging: a category -> label CASE ladder built from config."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CATEGORY_ALIASES, Hierarchy


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tag(h: Hierarchy, category: str | Column = "category", include: str | Column = "include") -> Column:
    """Label of ``category`` under ``h`` (``F.when`` chain; no Python UDF).

    With ``h.relabel_label`` set, rows with ``include = '0'`` take that label first.
    A NULL category falls to the default arm, as in SQL ``CASE``.
    """
    if isinstance(category, str) and isinstance(include, str):
        return F.expr(sql_tag(h, category, include))   # one JVM call for the whole ladder
    cat = _c(category)
    e = None
    if h.relabel_label is not None:
        e = F.when(_c(include) == "0", F.lit(h.relabel_label))
    for label, cats in h.arms:
        cond = cat.isin(list(cats))
        e = F.when(cond, F.lit(label)) if e is None else e.when(cond, F.lit(label))
    return e.otherwise(F.lit(h.default)) if e is not None else F.lit(h.default)


def alias_category(category: str | Column) -> Column:
    """Apply the fixed category code aliases (e.g. 'Acc & CE' -> 'Acc|CE')."""
    cat = _c(category)
    e = None
    for src, dst in CATEGORY_ALIASES:
        e = F.when(cat == src, F.lit(dst)) if e is None else e.when(cat == src, F.lit(dst))
    return e.otherwise(cat) if e is not None else cat


def sql_tag(h: Hierarchy, category: str = "category", include: str = "include") -> str:
    """The same ladder as Spark SQL text."""
    arms = []
    if h.relabel_label is not None:
        arms.append(f"WHEN {include} = '0' THEN '{h.relabel_label}'")
    for label, cats in h.arms:
        lst = ", ".join("'" + c.replace("'", "''") + "'" for c in cats)
        arms.append(f"WHEN {category} IN ({lst}) THEN '{label}'")
    return f"CASE {' '.join(arms)} ELSE '{h.default}' END"
