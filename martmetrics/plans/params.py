"""Run parameters for the registered queries on the driver's test tables."""

from __future__ import annotations

from ..config import TESTDATA

CFG = TESTDATA

# Month-end scorecard period (one month: New + Repeat = distinct buyers per cell).
SC_START, SC_END, MONTH_LABEL = "1998-07-01", "1998-07-31", "July-98"
# Months run one after the other from a carried state.
SC_MONTHS = (("1998-05-01", "1998-05-31"), ("1998-06-01", "1998-06-30"), ("1998-07-01", "1998-07-31"))
# Period (month-to-date) report.
PERIOD_START, PERIOD_END = "1998-07-01", "1998-07-31"
# Daily report: the local day of AS_OF minus N days.
AS_OF, N_DAYS = "2001-07-01 00:00:00", 0
# Relative-day filter demo: one day back from a mid-day clock.
AS_OF_OFFSET, N_OFFSET = "2001-07-02 10:00:00", 1
REPORT_DAY = "2001-07-01"
