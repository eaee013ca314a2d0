"""Run parameters.

Every stage takes a :class:`Params` instead of reading a clock, so one run has
exactly one reference time (``as_of``) from scoring through publishing and the
quality checks.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class Params:
    # Reference time of the run, UTC wall clock (naive datetime).
    as_of: datetime = datetime(2024, 1, 31)
    # Linear decay window; an engagement older than this weighs nothing.
    lookback_days: int = 90
    # Closest connections kept per user, and recommendations per user.
    n_closest: int = 50
    n_rec: int = 20
    # Candidates need a reputation strictly above this.
    min_score: float = 0.75
    # Weekly bins for message text: right-closed bins of `bin_days` days
    # counted from `anchor_date`, the last one ending at day `max_day`.
    anchor_date: date = date(2018, 9, 9)
    bin_days: int = 7
    max_day: int = 364
    # A user-week is positive when its probability is at least this.
    class_threshold: float = 0.5
    # Text model input: vocabulary cap (index 0 is padding) and sequence length.
    vocab_size: int = 18900
    seq_len: int = 1500
    # Published rows not refreshed within this many days are deleted.
    retention_days: int = 1

    @property
    def as_of_epoch(self) -> int:
        return calendar.timegm(self.as_of.timetuple())

    @property
    def lookback_seconds(self) -> int:
        return self.lookback_days * 86400

    @property
    def recent_since(self) -> date:
        """First calendar day a follow must fall on to count (date level)."""
        return (self.as_of - timedelta(days=self.lookback_days)).date()

    @property
    def expiry_cutoff(self) -> datetime:
        return self.as_of - timedelta(days=self.retention_days)

    def shifted(self, days: int) -> "Params":
        """Same parameters with the reference time moved by `days`."""
        return replace(self, as_of=self.as_of + timedelta(days=days))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
