"""Keep level-1 and level-2 rows in a table that later reports read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitgrid.periods import Periods
from profitgrid.plans.frames import Frames
from profitgrid.plans.report import summary
from profitgrid.sources import sinks

MONTHS = ["year", "month"]


def keep_summary(frames: Frames, periods: Periods, path: str, refresh: bool = False) -> DataFrame:
    """Compute the periods, store what is not stored yet, and return their stored rows.

    A stored region and month keeps its first values even when postings arrive later;
    ``refresh=True`` replaces the months instead.
    """
    rows = summary(frames, periods)
    if refresh:
        stored = sinks.refresh(rows, path, MONTHS)
    else:
        stored = sinks.append_if_absent(rows, path, partition_by=MONTHS)
    return stored.where(periods.in_years("year") & F.col("month").isin(*periods.months))
