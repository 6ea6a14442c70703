"""Calendar rules (S3, D2, D3) as driver-side date arithmetic or Columns."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, functions as F

# FIXED VALUES: month factors (month -> factor), default 1.0
SEASONALITY = {1: 1.15, 2: 1.0, 3: 1.05, 4: 1.0, 5: 0.95, 6: 0.85,
               7: 0.80, 8: 0.85, 9: 1.0, 10: 1.05, 11: 1.10, 12: 1.25}

# FIXED VALUES: weekday classes and their weight bounds (low, high);
# weekday() is 0 for Monday, as in Python.
WEEKDAY_BOUNDS = {"weekday": (0.9, 1.2), "saturday": (0.3, 0.5), "sunday": (0.05, 0.15)}

_DATE_RE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def parse_data_date(text: str) -> _dt.date:
    """Validate ``YYYY-MM-DD`` (raises ValueError otherwise)."""
    if not isinstance(text, str) or not _DATE_RE.match(text):
        raise ValueError("data_date must be YYYY-MM-DD")
    return _dt.datetime.strptime(text, "%Y-%m-%d").date()


def day_window(data_date: str, lookback_days: int = 0):
    """``[start, end)`` for a run date: end = midnight of data_date, start = end - 1 day
    (minus ``lookback_days`` more); the partition label is the start day."""
    if lookback_days < 0:
        raise ValueError("lookback_days must be >= 0")
    end = _dt.datetime.combine(parse_data_date(data_date), _dt.time())
    label_start = end - _dt.timedelta(days=1)
    start = label_start - _dt.timedelta(days=lookback_days)
    return start, end, label_start.date().isoformat()


def seasonality(date_col) -> Column:
    col = F.col(date_col) if isinstance(date_col, str) else date_col
    m = F.month(col)
    expr = None
    for month, factor in SEASONALITY.items():
        expr = F.when(m == month, F.lit(factor)) if expr is None else expr.when(m == month, F.lit(factor))
    return expr.otherwise(F.lit(1.0))


def weekday_class(date_col) -> Column:
    col = F.col(date_col) if isinstance(date_col, str) else date_col
    wd = F.weekday(col)
    return F.when(wd < 5, F.lit("weekday")).when(wd == 5, F.lit("saturday")).otherwise(F.lit("sunday"))


def weekday_bounds(date_col):
    """(low, high) weight bound Columns for the weekday class of a date."""
    cls = weekday_class(date_col)
    lo = hi = None
    for name, (a, b) in WEEKDAY_BOUNDS.items():
        lo = F.when(cls == name, F.lit(a)) if lo is None else lo.when(cls == name, F.lit(a))
        hi = F.when(cls == name, F.lit(b)) if hi is None else hi.when(cls == name, F.lit(b))
    return lo, hi
