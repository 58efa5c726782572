"""Configuration for the report operators.

Every vocabulary the operators test against lives here, as frozen dataclasses, so the
same operator runs on production data (the source jobs' own values) and on the driver's
TPC-H-like test tables (the ``TESTDATA`` variants at the bottom).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the source jobs' literals for right results.
# Kept verbatim and in their original order.
# ---------------------------------------------------------------------------

# Order / shipment / payment vocabularies.
BUYER_CANCEL = "SELLER_ORDER_BUYER_CANCEL"
CANCEL_STATUSES = ("SELLER_ORDER_BUYER_CANCEL", "SELLER_ORDER_SELLER_CANCEL", "SELLER_ORDER_EXPIRED")
SHIPMENT_RTS = "SHIPMENT_RTS"
SHIPMENT_DELIVERED = "SHIPMENT_DELIVERED"
RTO_STATUSES = ("SHIPMENT_RTO_ABSORBED", "SHIPMENT_RTO", "SHIPMENT_RTO_DELIVERED", "SHIPMENT_RTO_TO_SELLER")
CREDIT_MODES = ("CREDIT_PAY_LATER", "CREDIT", "PAY_LATER")

# Category lists of the business hierarchy (three slightly different variants exist).
FOOD = ("FMCG", "Core Staples", "Other Staples", "Fresh", "Sugar & Oil", "Meat")
PHARMA = ("Pharma",)
ELECTRONICS_DAILY = ("Featurephone", "LandlinePhones", "Refurbishedmobiles", "Smartphone",
                     "EN-Mobiles & Accessories", "Acc|CE", "IT")
ELECTRONICS_PERIOD = ("Featurephone", "LandlinePhones", "Refurbishedmobiles", "Smartphone", "Acc|CE", "IT")
ELECTRONICS_SNAPSHOT = ("Featurephone", "LandlinePhones", "Refurbishedmobiles", "Smartphone", "Acc & CE", "IT")
GENERAL_MERCHANDISE = ("Home & Kitchen", "Toys", "Luggage & Bags")
LIFESTYLE = ("Clothing", "Footwear")
ELECTRICAL = ("Electrical",)

# Category code alias applied when the override table is joined in.
CATEGORY_ALIASES = (("Acc & CE", "Acc|CE"),)

# Relabelling rules.
BRAND_RULE_BRAND = "Saffola"
BRAND_RULE_CATEGORY = "sugar & oil"      # compared lower-cased in the SQL jobs
BRAND_RULE_CATEGORY_EXACT = "Sugar & Oil"  # compared as-is in the snapshot job
BRAND_RULE_TARGET = "FMCG"
ELECTRICAL_RULE_TARGET = "Electrical"
ELECTRICAL_VERTICALS = (
    "Soap Dispensers", "CircuitBreakers", "DoorFittingsKit", "Bathroom Shelve", "Toilet Paper Holder",
    "Drain Cover", "Towel Holder", "Soap Dish and Tumbler Holder", "Hooks ", "Faucets & Taps",
    "Wall and Sink Mixer", "Shower", "Health Faucets", "Aldrop", "Latch", "Handles", "Tower Bolt",
    "Door Stopper", "Door Fittings Kit", "Door Closer", "Hinge", "Door Eye", "Mortise Locks", "Rim Locks",
    "Pad Locks", "Cabinet Locks", "Door Knobs/Cyllindrical Locks", "Cyllinder Locks", "Glass Lock",
    "Ledbulb", "Ledpanellight", "Ledstring", "LEDTubelight", "Emergencylight", "Ledlantern",
    "TubeHolders", "BulbHolder", "SwitchesandIndicators", "Sockets", "SwitchPlates",
    "SwitchSocketCombination", "MountingBox", "DoorChimesandBells", "PlugsandPins",
    "RegulatorandDimmer", "ExtensionCords", "Circuit Breaker", "Fans", "TowerBolt", "Faucet",
    "ElectricalWire",
)

# Outlier cap on GMV (order x listing in the SQL jobs, whole order in the snapshot job).
GMV_CAP = 200000

# Local day is UTC+05:30.
LOCAL_OFFSET_SECONDS = 19800
LOCAL_TZ = "Asia/Kolkata"

# Sheets skipped by the workbook normaliser.
SKIP_SHEETS = ("Food", "Clothing", "PL Clothing", "Hardware & Electricals", "Summary", "Sheet1", "Institution")

# Stamp row label of the daily stacked report.
STAMP_LABEL = "Script execution  Time :"

# Scorecard entity labels: (dim, prefix for a value, label for a NULL value).
SCORECARD_DIMS = (
    ("category", "category-", "category-null"),
    ("business_unit", "BU-", "BU-Null"),
    ("cust_cat_phones", "Custom Category-", "Custom_category_phones-Null"),
    ("cust_cat_hnk", "Custom Category-", "Custom_category_HNK-Null"),
    ("business_group", "Business Group-", "Business Group-NULL"),
    ("overall", None, "Overall"),
)
IGNORE_VALUE = "Ignore"

# Long-format scorecard rows, in output order: (particular, measure).
# The two warehouse labels carried an organisation name in the source; it is left out here
# and the labels can be replaced through the ``particulars`` argument of ``scorecard_long``.
PARTICULARS = (
    ("Placed GMV", "placed_gmv"),
    ("Shipped GMV", "shipped_gmv"),
    ("Delivered GMV", "delivered_gmv"),
    ("Cash and Carry - GMV", "cnc_gmv"),
    ("Marketplace fullfilled from WH - GMV", "warehouse_fulfilled_gmv"),
    ("Marketplace fullfilled from Seller - GMV", "seller_fulfilled_gmv"),
    ("New Buyers", "new_buyers"),
    ("Repeat Buyers", "repeat_buyers"),
    ("Total Buyers", "total_buyers"),
    ("Placed Orders", "placed_orders"),
    ("Shipped Orders", "shipped_orders"),
    ("Delivered Orders", "delivered_orders"),
    ("Cash and Carry", "cnc_orders"),
    ("Marketplace fullfilled from WH", "warehouse_fulfilled_orders"),
    ("Marketplace fullfilled from Seller", "seller_fulfilled_orders"),
    ("RTO %", "rto_gmv"),
    ("Credit GMV %", "credit_gmv"),
    ("# of Buyers on Credit", "credit_buyers"),
)

# ---------------------------------------------------------------------------
# Config types
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Hierarchy:
    """A CASE ladder: first matching arm wins, else ``default``.

    ``relabel_label`` (if set) is the first arm: rows whose ``include`` is '0'
    (relabelled copies) get that label before any category test.
    """

    arms: tuple[tuple[str, tuple[str, ...]], ...]
    default: str
    relabel_label: str | None = None


@dataclass(frozen=True)
class BrandRule:
    """Copy listings of ``brand`` in ``category`` with the category set to ``target``."""

    brand: str
    category: str
    target: str
    case_insensitive: bool = True


@dataclass(frozen=True)
class AllowListRule:
    """Copy rows whose org is in ``orgs`` and vertical in ``verticals`` as ``target``.

    ``skip_target``: do not copy rows already labelled ``target`` (snapshot variant).
    """

    orgs: tuple
    verticals: tuple[str, ...]
    target: str
    skip_target: bool = False


@dataclass(frozen=True)
class FulfilmentCodes:
    seller: tuple[str, ...]
    warehouse: tuple[str, ...]


@dataclass(frozen=True)
class CustomCuts:
    """Scorecard options. ``hnk_flag='phones'`` reproduces the source (HNK cut reuses the
    phones New/Repeat flag); ``'own'`` uses the HNK segment's own flag."""

    hnk_flag: str = "phones"


@dataclass(frozen=True)
class ReportConfig:
    daily_type: Hierarchy
    daily_type2: Hierarchy
    period_type: Hierarchy
    period_type2: Hierarchy
    snapshot_bg: Hierarchy
    snapshot_bu: Hierarchy
    brand_rule: BrandRule
    allow_rule: AllowListRule
    snapshot_brand_rule: BrandRule
    snapshot_allow_rule: AllowListRule
    fulfilment: FulfilmentCodes
    cap: float = GMV_CAP
    snapshot_cap: float = GMV_CAP
    cuts: CustomCuts = field(default_factory=CustomCuts)


def production(electrical_orgs: tuple, fulfilment: FulfilmentCodes) -> ReportConfig:
    """The source jobs' own lists. Seller org ids and fulfilment codes are site data and
    must be supplied by the caller."""
    type_arms = (("Food", FOOD), ("Pharma", PHARMA))
    return ReportConfig(
        daily_type=Hierarchy(type_arms, "Mario", "Dont Include"),
        daily_type2=Hierarchy((("Electronics", ELECTRONICS_DAILY), ("GM", GENERAL_MERCHANDISE),
                               ("Lifestyle", LIFESTYLE), ("Hardware & Electrical", ELECTRICAL)),
                              "Redundant Aggregate"),
        period_type=Hierarchy(type_arms, "Mario", "Dont Include:1"),
        period_type2=Hierarchy((("Electronics", ELECTRONICS_PERIOD), ("GM", GENERAL_MERCHANDISE),
                                ("Lifestyle", LIFESTYLE), ("Hardware & Electrical", ELECTRICAL)),
                               "Redundant Aggregate", "Dont Include:2"),
        snapshot_bg=Hierarchy(type_arms, "Mario"),
        snapshot_bu=Hierarchy((("Electronics", ELECTRONICS_SNAPSHOT), ("Hardware & Electrical", ELECTRICAL),
                               ("Lifestyle", LIFESTYLE), ("General Merchandise", GENERAL_MERCHANDISE)),
                              "Redundant"),
        brand_rule=BrandRule(BRAND_RULE_BRAND, BRAND_RULE_CATEGORY, BRAND_RULE_TARGET, True),
        allow_rule=AllowListRule(tuple(electrical_orgs), ELECTRICAL_VERTICALS, ELECTRICAL_RULE_TARGET),
        snapshot_brand_rule=BrandRule(BRAND_RULE_BRAND, BRAND_RULE_CATEGORY_EXACT, BRAND_RULE_TARGET, False),
        snapshot_allow_rule=AllowListRule(tuple(electrical_orgs), ELECTRICAL_VERTICALS,
                                          ELECTRICAL_RULE_TARGET, skip_target=True),
        fulfilment=fulfilment,
    )

# ---------------------------------------------------------------------------
# Test-data variant: the driver's TPC-H-like tables carry eight part "categories"
# (second word of p_name). These lists give every arm of every ladder some rows.
# ---------------------------------------------------------------------------

TESTDATA_CATEGORIES = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
TESTDATA_ALLOWED_ORGS = (1, 2, 3, 4, 5)
TESTDATA_VERTICALS = ("blue ring", "small ring", "red widget")

_td_type_arms = (("Food", ("anvil", "bolt")), ("Pharma", ("gear",)))
_td_type2_arms = (("Electronics", ("gizmo",)), ("GM", ("ring", "rod")), ("Lifestyle", ("widget",)),
                  ("Hardware & Electrical", ("plate",)))

TESTDATA = ReportConfig(
    daily_type=Hierarchy(_td_type_arms, "Mario", "Dont Include"),
    daily_type2=Hierarchy(_td_type2_arms, "Redundant Aggregate"),
    period_type=Hierarchy(_td_type_arms, "Mario", "Dont Include:1"),
    period_type2=Hierarchy(_td_type2_arms, "Redundant Aggregate", "Dont Include:2"),
    snapshot_bg=Hierarchy(_td_type_arms, "Mario"),
    snapshot_bu=Hierarchy((("Electronics", ("gizmo",)), ("Hardware & Electrical", ("plate",)),
                           ("Lifestyle", ("widget",)), ("General Merchandise", ("ring", "rod"))), "Redundant"),
    brand_rule=BrandRule("Brand#1", "anvil", "bolt", True),
    allow_rule=AllowListRule(TESTDATA_ALLOWED_ORGS, TESTDATA_VERTICALS, "plate"),
    snapshot_brand_rule=BrandRule("Brand#1", "anvil", "bolt", False),
    snapshot_allow_rule=AllowListRule(TESTDATA_ALLOWED_ORGS, TESTDATA_VERTICALS, "plate", skip_target=True),
    fulfilment=FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",)),
    cap=80000,
    snapshot_cap=GMV_CAP,
)
