"""Zone-independent time literals.

``F.lit(datetime)`` makes a session-zone TIMESTAMP, so a wall-clock value
would move with ``spark.sql.session.timeZone``.  Source times are zone-less,
so literals go through ISO text straight to TIMESTAMP_NTZ.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO text (Columns pass through)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, _dt.date):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    raise TypeError(f"not a time value: {value!r}")
