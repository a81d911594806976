"""Report-date parsing.

The pull's report date is written month/day/year.  In Spark patterns ``mm``
is minutes, so the month must be ``MM``: ``to_date('02/28/2013',
'mm/dd/yyyy')`` silently gives 2013-01-28.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the month/day/year layout of report dates.
REPORT_DATE_PATTERN = "MM/dd/yyyy"


def to_report_date(text: Column | str) -> Column:
    """A month/day/year string column as a date (NULL when it does not parse)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c, F.lit(REPORT_DATE_PATTERN)).cast("date")


def parse_report_date(text: str | dt.date) -> dt.date:
    """A month/day/year string (or a date) as a ``datetime.date``."""
    if isinstance(text, dt.date):
        return text
    return dt.datetime.strptime(text.strip(), "%m/%d/%Y").date()
