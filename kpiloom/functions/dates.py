"""Date and time expressions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts of the inputs.
FEED_DATE = "yyyy/MM/dd"
FLAT_SALES_TIME = "yyyy/MM/dd H:m:s"
FLAT_CANCEL_TIME = "M/d/yyyy H:m"
FLAT_CANCEL_DATE = "M/d/yyyy"
# Accepts one-digit parts, which the conformed recovery files contain.
CONFORMED_TIME = "yyyy/M/d H:m"
OUTPUT_TIME = "yyyy-MM-dd HH:mm:ss"

UTC_PLUS_8 = timezone(timedelta(hours=8))
_WIDGET_TIME = "%Y-%m-%d %H:%M:%S"


def norm_ts(c: Column, pattern: str) -> Column:
    """Text in `pattern` -> text `yyyy-MM-dd HH:mm:ss`, unparsable -> NULL.

    Read and printed in the zone of the session, which should be one without
    daylight saving (see session.py): it has every local time once. Empty texts, which
    most orders have for a date, are set aside: each would cost the parser an exception.
    """
    return F.date_format(F.try_to_timestamp(F.nullif(c, F.lit("")), F.lit(pattern)), OUTPUT_TIME)


def norm_iso(c: Column) -> Column:
    """ISO text -> text `yyyy-MM-dd HH:mm:ss`, without any zone shift."""
    return F.left(c.try_cast("timestamp_ntz").cast("string"), F.lit(len("yyyy-MM-dd HH:mm:ss")))


def parse_output_time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(OUTPUT_TIME))


def file_date(path: Column) -> Column:
    """Business date out of a page name such as `CN-20240501-Sales-1.json`."""
    digits = F.regexp_extract(path, r"-(\d{8})-[^/]*$", 1)
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date")


def local_time(value: datetime | str) -> Column:
    """A time without zone, as it reads; the zone of the Python process plays no part."""
    return F.lit(str(value)).cast("timestamp_ntz")


def ingestion_ts(now: datetime | str | None = None) -> Column:
    """Time of the load, or a given local time in the zone of the session."""
    return F.current_timestamp() if now is None else local_time(now).cast("timestamp")


def request_window(
    start: str | None = None,
    end: str | None = None,
    now: datetime | None = None,
    tz: timezone = UTC_PLUS_8,
) -> tuple[datetime, datetime]:
    """Half-open request window as local times, by default the whole of yesterday.

    A bound that is blank or cannot be parsed takes its default: midnight today
    for the end, one day before the end for the start.
    """
    local = datetime.now(tz) if now is None else now.astimezone(tz) if now.tzinfo else now

    def parsed(text: str | None) -> datetime | None:
        try:
            return datetime.strptime((text or "").strip(), _WIDGET_TIME)
        except ValueError:
            return None

    hi = parsed(end) or datetime(local.year, local.month, local.day)
    lo = parsed(start) or hi - timedelta(days=1)
    return lo, hi


def in_window(c: Column, lo: datetime | Column, hi: datetime | Column) -> Column:
    """Half-open range test, so that windows in a row neither overlap nor leave a gap."""
    first, stop = (bound if isinstance(bound, Column) else local_time(bound) for bound in (lo, hi))
    return (c >= first) & (c < stop)
