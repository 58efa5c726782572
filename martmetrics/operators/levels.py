"""Level roll-ups: orders / buyers / GMV at several levels, stacked.

Several conditional ``count(distinct ...)`` measures make Spark expand every row once per
distinct expression. Here every row is expanded once per *key grain* instead (order id,
buyer id), all conditional flags of one grain are folded with ``max`` at
(level, entity, key) — partial aggregation runs map-side, so a hot key never reaches one
task whole — and a second, tiny aggregation counts flagged keys per (level, entity).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates as P
from ..functions.scalars import safe_ratio


@dataclass(frozen=True)
class Measures:
    """A measure set, as Spark SQL expression text over the input columns.

    ``order_flags`` / ``buyer_flags``: name -> condition; the measure is the number of
    distinct non-NULL keys on rows where the condition holds (NULL counts as false).
    ``sums``: name -> value expression (money; summed exactly, returned as double).
    ``ratios``: name -> (numerator measure, denominator measure).
    ``order``: output column order.
    Text keeps a whole projection to one JVM call when the plan is built.
    """

    order_flags: Mapping[str, str]
    buyer_flags: Mapping[str, str]
    sums: Mapping[str, str]
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    order: Sequence[str] = ()


def daily_measures() -> Measures:
    return Measures(
        order_flags={"orders": "true"},
        buyer_flags={"buyers": "true"},
        sums={"gmv": "gmv"},
        ratios={"aov": ("gmv", "orders")},
        order=("orders", "buyers", "gmv", "aov"),
    )


def period_measures(full: bool = True) -> Measures:
    nb = P.NOT_BUYER_CANCELLED_SQL
    order_flags = {"orders": nb}
    sums = {
        "placed_gmv_excl_buyer_cncl": f"CASE WHEN {nb} THEN gmv END",
        "placed_gmv_excl_buyer_seller_cncl_exp": f"CASE WHEN {P.NOT_CANCELLED_SQL} THEN gmv END",
        "shipped_gmv": "shipped_gmv",
    }
    order = ["orders", "buyers", "placed_gmv_excl_buyer_cncl", "aov",
             "placed_gmv_excl_buyer_seller_cncl_exp", "shipped_gmv"]
    if full:
        order_flags.update({"shipped_orders": P.SHIP_SQL, "delivered_orders": P.DELIVERED_SQL})
        order += ["shipped_orders", "delivered_orders"]
    return Measures(order_flags=order_flags, buyer_flags={"buyers": nb}, sums=sums,
                    ratios={"aov": ("placed_gmv_excl_buyer_cncl", "orders")}, order=tuple(order))


def stack_levels(df: DataFrame, levels: Sequence[tuple[str, Column]]) -> DataFrame:
    """One output row per input row and level: adds ``level`` and string ``entity``.

    The hand-written ``UNION ALL`` of per-level aggregates becomes one scan; ``level``
    keeps a NULL entity apart from a total.
    """
    arr = F.array(*[F.struct(F.lit(name).alias("level"), (F.expr(c) if isinstance(c, str) else c)
                             .cast("string").alias("entity")) for name, c in levels])
    return df.select("*", F.inline(arr))


def level_rank(names: Sequence[str]) -> Column:
    """Place of ``level`` among ``names``, from 1: sort a report by ``level_rank, entity``."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), F.col("level")).cast("int").alias("level_rank")


def distinct_measures(df: DataFrame, keys: Sequence[str], m: Measures,
                      order_key: str = "order_id", buyer_key: str = "buyer_org_id",
                      anchors: Sequence[Sequence[str]] = (), exact: bool = False) -> DataFrame:
    """Grouped measures of ``m`` by ``keys`` (two-level distinct; see module doc).

    ``exact``: decimal sums stay decimal instead of becoming double.

    ``anchors``: key tuples (string literals) whose group must exist even when no input
    row has them — e.g. a Grand Total on empty input. Each adds one neutral row (no key,
    no amount) to the level-1 input, so no join is needed to materialise the group.
    """
    keys = list(keys)
    of, bf, sums = list(m.order_flags), list(m.buyer_flags), list(m.sums)
    types = df.selectExpr(*[f"{m.sums[n]} AS {n}" for n in sums]).schema if sums else None
    ok_t = df.schema[order_key].dataType.simpleString()
    bk_t = df.schema[buyer_key].dataType.simpleString()

    # A decimal(<=18, s) sum is carried as exact integer units of 10^-s in a bigint: the
    # aggregation stays on the fast primitive path (ANSI mode raises on overflow).
    unit = {n: 10 ** types[n].dataType.scale for n in sums
            if isinstance(types[n].dataType, T.DecimalType) and types[n].dataType.precision <= 18}

    def s_value(n: str, g: str) -> str:
        v = m.sums[n] if g == "o" else "NULL"
        if n in unit:
            return f"CAST(({v}) * {unit[n]} AS BIGINT)"
        return f"CAST({v} AS {types[n].dataType.simpleString()})"

    def grain(g: str) -> str:
        mine = m.order_flags if g == "o" else m.buyer_flags
        fields = [f"'g', '{g}'",
                  f"'ok', CAST({order_key if g == 'o' else 'NULL'} AS {ok_t})",
                  f"'bk', CAST({buyer_key if g == 'b' else 'NULL'} AS {bk_t})",
                  *[f"'f_{n}', " + (P.sql_flag(mine[n]) if n in mine else "CAST(NULL AS INT)") for n in of + bf],
                  *[f"'s_{n}', {s_value(n, g)}" for n in sums]]
        return f"named_struct({', '.join(fields)})"

    x = df.selectExpr(*keys, f"inline(array({grain('o')}, {grain('b')}))")
    if anchors:
        neutral = ["'o' AS g", f"CAST(NULL AS {ok_t}) AS ok", f"CAST(NULL AS {bk_t}) AS bk",
                   *[f"CAST(NULL AS INT) AS f_{n}" for n in of + bf]]
        for a in anchors:
            row = df.sparkSession.range(1).selectExpr(
                *[f"{P.sql_lit(v)} AS {k}" for k, v in zip(keys, a)], *neutral,
                *[f"CAST(NULL AS {x.schema['s_' + n].dataType.simpleString()}) AS s_{n}" for n in sums])
            x = x.unionByName(row)
    lvl1 = x.groupBy(*keys, "g", "ok", "bk").agg(
        *[F.expr(f"max(f_{n}) AS f_{n}") for n in of + bf], *[F.expr(f"sum(s_{n}) AS s_{n}") for n in sums])
    is_o, is_b = "g = 'o' AND ok IS NOT NULL", "g = 'b' AND bk IS NOT NULL"
    lvl2 = lvl1.groupBy(*keys).agg(
        *[F.expr(f"count(CASE WHEN {is_o} AND f_{n} = 1 THEN 1 END) AS {n}") for n in of],
        *[F.expr(f"count(CASE WHEN {is_b} AND f_{n} = 1 THEN 1 END) AS {n}") for n in bf],
        *[F.expr(f"sum(CAST(s_{n} AS DECIMAL(28, 0))) / {unit[n]} AS {n}" if n in unit else f"sum(s_{n}) AS {n}")
          for n in sums])
    if exact:
        lvl2 = lvl2.withColumns({n: F.col(n).cast(f"decimal(38, {types[n].dataType.scale})") for n in unit})
    return _finish(lvl2, keys, m, unit if exact else ())


def _finish(agg: DataFrame, keys: Sequence[str], m: Measures, exact: Sequence[str] = ()) -> DataFrame:
    cols = {n: F.col(n).cast("double") for n in m.sums if n not in exact}
    cols.update({n: safe_ratio(F.col(a), F.col(b)) for n, (a, b) in m.ratios.items()})
    out = agg.withColumns(cols) if cols else agg
    order = list(m.order) or [*m.order_flags, *m.buyer_flags, *m.sums, *m.ratios]
    return out.select(*keys, *order)


def stacked_report(df: DataFrame, levels: Sequence[tuple[str, Column]], m: Measures,
                   total_label: str = "Grand Total", exact: bool = False) -> DataFrame:
    """Grand-total row + one block per level, as (level, entity, measures..., level_rank).

    The total comes out of the same single pass as the levels; a neutral anchor row
    makes the total row exist (with zero counts) on empty input too, as a global
    aggregate without GROUP BY does.
    """
    all_levels = [("total", F.lit(total_label)), *levels]
    return distinct_measures(stack_levels(df, all_levels), ["level", "entity"], m,
                             anchors=[("total", total_label)], exact=exact).select(
                                 "level", "entity", *m.order, level_rank([n for n, _ in all_levels]))
