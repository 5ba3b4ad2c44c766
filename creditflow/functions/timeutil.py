"""Time helpers on zone-less (NTZ) timestamps that hold UTC.

* ``to_zone``: UTC wall time -> wall time in ``zone`` (DST-aware for region
  ids such as ``America/Detroit``; ``EST`` is the fixed -05:00 offset).
* ``shift``: add whole units to a timestamp and keep the time of day
  (unlike ``F.date_add``, which returns a date).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zones the job converts to.
ORDER_ZONE = "America/Detroit"   # order dates, mark and lookback filters, export label
TOUCH_ZONE = "EST"               # bid time and touch times

_UNITS = {"second": "SECOND", "minute": "MINUTE", "hour": "HOUR", "day": "DAY", "week": "WEEK"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_zone(ts, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def local_order_time(ts) -> Column:
    return to_zone(ts, ORDER_ZONE)


def touch_time(ts) -> Column:
    return to_zone(ts, TOUCH_ZONE)


def shift(ts, n, unit: str = "day") -> Column:
    """Timestamp ``ts`` moved by ``n`` units; ``n`` may be a Column or an int."""
    qty = n if isinstance(n, Column) else F.lit(int(n))
    return F.timestamp_add(_UNITS[unit], qty, _col(ts))


def format_ts(ts) -> Column:
    """``YYYY-MM-DD HH24:MI:SS`` text of a zone-less time, whatever the session's time zone."""
    return F.substring(_col(ts).cast("timestamp_ntz").cast("string"), 1, 19)
