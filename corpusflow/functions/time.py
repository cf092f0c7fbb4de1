"""Time column functions (P14, P15). Instants are TIMESTAMP_NTZ holding UTC."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_TZ = "Asia/Seoul"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(t: _dt.datetime | str) -> Column:
    """A UTC instant literal as TIMESTAMP_NTZ (independent of the session zone)."""
    s = t if isinstance(t, str) else t.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(s).cast("timestamp_ntz")


def business_date(ts, tz: str = BUSINESS_TZ) -> Column:
    """'yyyy-MM-dd' date of a UTC instant in the business time zone."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(ts)), "yyyy-MM-dd")


def lease_expiry(now, seconds) -> Column:
    """now + seconds."""
    now = now if isinstance(now, Column) else ts_lit(now)
    secs = seconds if isinstance(seconds, Column) else F.lit(int(seconds))
    return F.timestamp_add("SECOND", secs, now)


def fmt_ts(c) -> Column:
    """Render an instant for comparisons and reports."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")
