"""Inclusive date windows, resolved on the driver so that scans see literal bounds and prune."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions.values import FIRST_PARTITION_DATE


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def logical_date(ds: str | dt.date | None, run_started: dt.datetime | None = None) -> dt.date:
    """The run's date: ``ds`` if given, else the day the run started. Never the clock."""
    if ds is not None:
        return as_date(ds)
    if run_started is None:
        raise ValueError("give ds or the run's start time")
    return run_started.date()


@dataclass(frozen=True)
class DateWindow:
    """``lo .. hi``; a window with ``lo > hi`` is empty and holds no date."""

    lo: dt.date
    hi: dt.date

    def holds(self, column: str) -> Column:
        return F.col(column).between(F.lit(self.lo), F.lit(self.hi))

    def holds_text(self, column: str) -> Column:
        """For a text partition column: text is compared with text so that pruning still works."""
        return F.col(column).between(F.lit(self.lo.isoformat()), F.lit(self.hi.isoformat()))

    def earlier(self, days: int) -> DateWindow:
        return DateWindow(self.lo - dt.timedelta(days=days), self.hi)

    def dates(self) -> list[dt.date]:
        return [self.lo + dt.timedelta(days=i) for i in range((self.hi - self.lo).days + 1)]


def backfill_window(ds: str | dt.date, days: int = 1,
                    floor: str | dt.date = FIRST_PARTITION_DATE) -> DateWindow:
    """``ds - days .. ds``, never reaching below ``floor``."""
    hi = as_date(ds)
    return DateWindow(max(hi - dt.timedelta(days=int(days)), as_date(floor)), hi)


def event_window(event: str, ds: str | dt.date, days: int = 1,
                 per_event: Mapping[str, int] | None = None, override: int | None = None,
                 floor: str | dt.date = FIRST_PARTITION_DATE) -> DateWindow:
    """Window of one event type: ``override``, else its own entry, else the common ``days``."""
    n = override if override is not None else (per_event or {}).get(event, days)
    return backfill_window(ds, n, floor)
