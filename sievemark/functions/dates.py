"""Time expressions. Timestamps are UTC instants (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/Paris"

# Month names and the six named output formats.
MONTHS_FR = [
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
]
LOCAL_FORMATS = {
    "full": "dd/MM/yyyy HH:mm:ss",
    "datetime": "dd/MM/yyyy HH:mm:ss",
    "compact": "dd/MM HH:mm",
    "time": "HH:mm:ss",
    "date": "dd/MM/yyyy",
    "iso": "yyyy-MM-dd'T'HH:mm:ss",
}


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a UTC instant; ``Z`` and offsets accepted, naive text is UTC,
    fractions beyond 6 digits are cut, malformed text gives NULL."""
    cut = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    return cut.try_cast("timestamp")


def date_text_fr(ts: Column) -> Column:
    """``21 mai 2026 à 23h12``."""
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS_FR]), F.month(ts))
    return F.concat(
        F.dayofmonth(ts).cast("string"), F.lit(" "), month, F.lit(" "), F.year(ts).cast("string"),
        F.lit(" à "), F.date_format(ts, "HH'h'mm"),
    )


def local_time(ts: Column, fmt: str = "full", zone: str = LOCAL_ZONE) -> Column:
    """UTC instant or ISO text in local time, in a named format; NULL gives ''."""
    if fmt not in LOCAL_FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {list(LOCAL_FORMATS)}")
    utc = ts.cast("timestamp")
    local = F.from_utc_timestamp(utc, zone)
    text = F.date_format(local, LOCAL_FORMATS[fmt])
    if fmt in ("full", "iso"):
        hours = F.timestamp_diff("HOUR", utc, local)
        if fmt == "full":
            name = F.when(hours == 2, "CEST").when(hours == 1, "CET").otherwise(F.lit(zone))
            text = F.concat(text, F.lit(" ("), name, F.lit(")"))
        else:
            text = F.concat(text, F.format_string("+%02d00", hours))
    return F.coalesce(text, F.lit(""))


def duration_text(start: Column, end: Column) -> Column:
    """``XmYYs`` between two ISO texts, ``-`` when either is missing or malformed."""
    seconds = F.timestamp_diff("SECOND", parse_iso(start), parse_iso(end))
    minutes = F.floor(seconds / 60)
    text = F.concat(
        minutes.cast("string"), F.lit("m"), F.lpad((seconds - minutes * 60).cast("string"), 2, "0"), F.lit("s")
    )
    return F.coalesce(text, F.lit("-"))


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def report_timestamp(name: Column) -> Column:
    """``drift_YYYYMMDD_HHMM`` (with or without extension) to a timestamp, NULL when malformed."""
    digits = F.regexp_extract(name, r"^(?:drift_)?(\d{8}_\d{4})(?:\.[^.]*)?$", 1)
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd_HHmm"))


def stamp(ts: Column) -> Column:
    """Second-precision text of an instant, for output tables."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
