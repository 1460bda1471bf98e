"""Local time, independent of the session time zone.

Logs carry epoch seconds, and days and hours are those of the shop's own zone.  All expressions go through zone-less
timestamps, so the zone a session happens to run in never leaks into a result.  (Casts between zoned and zone-less
timestamps and ``timestampdiff`` of zone-less ones would use the session zone and are avoided.)
"""

from pyspark.sql import functions as F

SHOP_ZONE = "Asia/Shanghai"

# Seconds of 0001-01-01 and 9999-12-31: what a four-digit date can hold, whatever the zone adds.
FIRST_SECOND, LAST_SECOND = -62135510400, 253402214400
_YEAR_SECONDS = 60 * 60 * 24 * 365


def _column(c):
    return F.col(c) if isinstance(c, str) else c


def in_range(epoch_seconds):
    return _column(epoch_seconds).between(FIRST_SECOND, LAST_SECOND)


def local_time(epoch_seconds, zone=SHOP_ZONE):
    """Epoch seconds as a wall-clock timestamp in ``zone``; NULL when no date can hold it."""
    seconds = F.when(in_range(epoch_seconds), _column(epoch_seconds))
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.expr("INTERVAL '1' SECOND") * seconds
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def second_of_day(local):
    return F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)


def wall_seconds(local):
    """Seconds from 1970-01-01 00:00:00 to a wall-clock timestamp, both read on the same clock."""
    days = F.datediff(F.to_date(local), F.lit("1970-01-01").cast("date"))
    return days.cast("long") * 86400 + second_of_day(local)


def wall_micros(local):
    """``wall_seconds`` in microseconds, with the fraction of the second."""
    fraction = F.extract(F.lit("SECOND"), local) - F.second(local)
    return wall_seconds(local) * 1_000_000 + (fraction * 1_000_000).cast("long")


def day_text(local):
    return F.to_date(local).cast("string")


def hour_text(local):
    """Hour of day without padding: "0" to "23"."""
    return F.hour(local).cast("string")


def minute_text(local):
    return F.date_format(local, "yyyy-MM-dd HH:mm")


def parse_local(text):
    """A ``yyyy-MM-dd HH:mm:ss`` string as a wall-clock timestamp; NULL when it is not one."""
    text = _column(text)
    shaped = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), text)
    return shaped.try_cast("timestamp_ntz")


def previous_day(day):
    """The ISO day before an ISO day string."""
    return F.date_sub(F.to_date(day), 1).cast("string")


def age_years(birthday, as_of):
    """Whole 365-day years from a ``yyyy-MM-dd`` birthday to ``as_of``, a wall-clock timestamp."""
    days = F.datediff(F.to_date(as_of), _column(birthday).try_cast("date"))
    seconds = days.cast("long") * 86400 + second_of_day(as_of)
    return F.call_function("div", seconds, F.lit(_YEAR_SECONDS)).cast("int")


def wall_clock(text):
    """A literal wall-clock timestamp."""
    return F.lit(text).cast("timestamp_ntz")
