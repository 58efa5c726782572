"""Expected hierarchy labels of the test data for the oracle SQL, written out by hand.

The queries build their CASE ladders from the configuration; these do not, so a wrong arm,
order or label there shows up as a difference.
"""

DAILY_TYPE = """CASE WHEN include = '0' THEN 'Dont Include' WHEN category IN ('anvil', 'bolt') THEN 'Food'
  WHEN category = 'gear' THEN 'Pharma' ELSE 'Mario' END"""

DAILY_TYPE2 = """CASE category WHEN 'gizmo' THEN 'Electronics' WHEN 'ring' THEN 'GM' WHEN 'rod' THEN 'GM'
  WHEN 'widget' THEN 'Lifestyle' WHEN 'plate' THEN 'Hardware & Electrical' ELSE 'Redundant Aggregate' END"""

PERIOD_TYPE = """CASE WHEN include = '0' THEN 'Dont Include:1' WHEN category IN ('anvil', 'bolt') THEN 'Food'
  WHEN category = 'gear' THEN 'Pharma' ELSE 'Mario' END"""

PERIOD_TYPE2 = f"CASE WHEN include = '0' THEN 'Dont Include:2' ELSE {DAILY_TYPE2} END"

SNAPSHOT_BG = """CASE category WHEN 'anvil' THEN 'Food' WHEN 'bolt' THEN 'Food' WHEN 'gear' THEN 'Pharma'
  ELSE 'Mario' END"""

SNAPSHOT_BU = """CASE category WHEN 'gizmo' THEN 'Electronics' WHEN 'plate' THEN 'Hardware & Electrical'
  WHEN 'widget' THEN 'Lifestyle' WHEN 'ring' THEN 'General Merchandise' WHEN 'rod' THEN 'General Merchandise'
  ELSE 'Redundant' END"""
