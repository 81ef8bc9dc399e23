"""Time bins and look-back windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
HOUR = dt.timedelta(hours=1)


def bin_time(ts: Column, width: dt.timedelta = HOUR) -> Column:
    """Start of the ``width`` bin that holds ``ts``.

    Bins are aligned to the epoch, so they do not depend on the session zone.
    """
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width // dt.timedelta(microseconds=1))))


def utc_date(ts: Column) -> Column:
    """The UTC day of ``ts``, whatever the session zone."""
    seconds = F.unix_seconds(ts)
    return F.date_from_unix_date(((seconds - F.pmod(seconds, F.lit(86400))) / 86400).cast("int"))


def instant(at: dt.datetime) -> Column:
    """A point in time as a constant; without a zone it is UTC."""
    at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit((at - EPOCH) // dt.timedelta(microseconds=1)))


def moment(as_of: Column | dt.datetime | str | None) -> Column:
    """A fixed instant as a column, or the query's own start when None."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        return instant(as_of)
    return F.lit(as_of).cast("timestamp")


def look_back(as_of: Column | dt.datetime | str | None, back: dt.timedelta) -> Column:
    """The instant ``back`` before ``as_of``; constant within a query."""
    return moment(as_of) - F.make_dt_interval(secs=F.lit(back // dt.timedelta(seconds=1)))


def time_after(ts: Column, as_of: Column | dt.datetime | str | None, back: dt.timedelta) -> Column:
    """True where ``ts`` is later than ``back`` before ``as_of``, strictly."""
    return ts > look_back(as_of, back)
