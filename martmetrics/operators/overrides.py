"""SKU relabelling: the override table (SQL jobs) and relabelled copies (snapshot job).

A listing keeps its base label row (``include='1'``) and gains one copy
(``include='0'``) per rule it matches; joining transactions to the table therefore fans
a line out to 1-3 rows on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AllowListRule, BrandRule


def _brand_cond(rule: BrandRule, brand: str, category: str):
    cat = F.lower(F.col(category)) if rule.case_insensitive else F.col(category)
    want = rule.category.lower() if rule.case_insensitive else rule.category
    return (F.col(brand) == rule.brand) & (cat == want)


def sku_overrides(listing: DataFrame, category_map: DataFrame, brand_rule: BrandRule,
                  allow_rule: AllowListRule | None = None) -> DataFrame:
    """(listing_id, brand, vertical, rt_mis_category, include) label rows.

    Base rows: every listing with its mapped category (vertical and category NULL when
    the vertical is unmapped). Copies: the brand rule (tested on the mapped category)
    and, if given, the org x vertical allow-list rule (tested on the listing's own
    vertical). Each branch is de-duplicated on its own, like ``SELECT DISTINCT ... UNION
    ALL ...``; all branches come out of one scan and one aggregation.
    """
    cm = category_map.select(F.col("vertical").alias("cm_vertical"), "rt_mis_category")
    j = listing.join(cm, listing["vertical"] == cm["cm_vertical"], "left")
    cands = [F.struct(F.lit(0).alias("branch"), F.col("rt_mis_category").alias("rt"), F.lit("1").alias("inc"))]
    cands.append(F.when(_brand_cond(brand_rule, "brand", "rt_mis_category"),
                        F.struct(F.lit(1).alias("branch"), F.lit(brand_rule.target).alias("rt"),
                                 F.lit("0").alias("inc"))))
    if allow_rule is not None:
        cond = F.col("org_id").isin(list(allow_rule.orgs)) & F.col("vertical").isin(list(allow_rule.verticals))
        cands.append(F.when(cond, F.struct(F.lit(2).alias("branch"), F.lit(allow_rule.target).alias("rt"),
                                           F.lit("0").alias("inc"))))
    x = j.select("listing_id", "brand", F.col("cm_vertical").alias("vertical"),
                 F.explode(F.array(*cands)).alias("c")).filter(F.col("c").isNotNull())
    return (x.select("listing_id", "brand", "vertical", F.col("c.branch").alias("branch"),
                     F.col("c.rt").alias("rt_mis_category"), F.col("c.inc").alias("include"))
            .distinct().drop("branch"))


def relabelled_copies(raw: DataFrame, brand_rule: BrandRule, allow_rule: AllowListRule | None,
                      category_col: str = "rt_mis_category") -> DataFrame:
    """Snapshot variant: base rows (``include=1``) plus copies of matching transaction rows
    with ``category_col`` overwritten and ``include=0``.

    The allow-list rule tests the *transaction's* seller org, and with ``skip_target``
    leaves rows already labelled with the target alone (a NULL label is not skipped,
    as pandas ``~isin`` keeps NaN). One scan: each row is exploded into itself plus any
    copies.
    """
    cands = [F.struct(F.col(category_col).alias("_cat"), F.lit(1).alias("_inc"))]
    bc = _brand_cond(brand_rule, "brand", category_col)
    cands.append(F.when(bc, F.struct(F.lit(brand_rule.target).alias("_cat"), F.lit(0).alias("_inc"))))
    if allow_rule is not None:
        cond = F.col("seller_org_id").isin(list(allow_rule.orgs)) & F.col("vertical").isin(list(allow_rule.verticals))
        if allow_rule.skip_target:
            cond = cond & ~F.coalesce(F.col(category_col) == allow_rule.target, F.lit(False))
        cands.append(F.when(cond, F.struct(F.lit(allow_rule.target).alias("_cat"), F.lit(0).alias("_inc"))))
    cols = [c for c in raw.columns if c not in (category_col, "include")]
    x = raw.select(*cols, F.explode(F.array(*cands)).alias("_c")).filter(F.col("_c").isNotNull())
    return x.select(*cols, F.col("_c._cat").alias(category_col), F.col("_c._inc").alias("include"))
