"""From a time to its business day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def business_day(time: Column | str) -> Column:
    """The day a time belongs to.

    Preferred over truncation: Catalyst rewrites a comparison of this form
    with a literal day into a range on the raw time, which reaches the scan.
    """
    return F.to_date(time)


def business_day_trunc(time: Column | str) -> Column:
    """The same day by truncation, for callers that need a midnight time."""
    column = F.col(time) if isinstance(time, str) else time
    return F.date_trunc("DAY", column).cast("timestamp_ntz")
