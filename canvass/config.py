"""Run parameters of one survey pull."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Parameters of one pull.

    ``report_date`` is the in-force snapshot period, ``as_of`` the day the
    pull runs (cancellations effective on or after it are excluded).  The
    sample sizes default to the production pull (80,000 and 60,000); the
    fixture queries use smaller sizes, see :data:`FIXTURE_CONFIG`.
    """

    report_date: dt.date = dt.date(2013, 2, 28)
    as_of: dt.date = dt.date(2013, 3, 1)
    n_main: int = 80_000
    n_new: int = 60_000
    seed: int = 42
    # Tables of at most this many bytes are broadcast; larger ones are joined
    # by shuffle (see operators.joins.dimension).  The bytes are those of the
    # compressed files; in memory a table can be ten times as large, so the
    # bound stays well below what an executor can hold.
    broadcast_max_bytes: int = 16 << 20
    # A key (policyholder) with more rows than this is split over several
    # tasks when its per-key aggregate is joined back (operators.skew).
    hot_key_rows: int = 1_000_000
    # "table" writes shared stages as parquet under spark.checkpoint.dir and
    # reads them back (lineage cut, pruning and pushdown on later reads);
    # "checkpoint" uses Dataset.checkpoint there; "persist" keeps them in
    # executor memory/disk with the lineage; "none" recomputes.
    materialize: str = "table"

    def __post_init__(self) -> None:
        if self.n_main < 0 or self.n_new < 0:
            raise ValueError("sample sizes must be non-negative")
        if self.broadcast_max_bytes < 0 or self.hot_key_rows < 1:
            raise ValueError("broadcast_max_bytes must be >= 0 and hot_key_rows >= 1")
        if self.materialize not in ("table", "checkpoint", "persist", "none"):
            raise ValueError(f"unknown materialize mode {self.materialize!r}")

    @classmethod
    def from_text(cls, report_date: str, as_of: str, **kw) -> "Config":
        """Dates written month/day/year, e.g. ``Config.from_text("02/28/2013", "03/01/2013")``."""
        from canvass.functions.dates import parse_report_date
        return cls(report_date=parse_report_date(report_date), as_of=parse_report_date(as_of), **kw)


# The fixture tables hold a few thousand policyholders, so the production
# sample sizes would take the whole population and leave the second pool
# empty.  These sizes keep both samples proper subsets at every fixture scale.
FIXTURE_CONFIG = Config(n_main=200, n_new=100)
