"""Timestamp parsing and the rules that derive ``known_at``.

The session time zone is UTC.  Local provider times are nine hours ahead and
have no daylight saving, so a fixed offset is exact.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import clean

_JST_OFFSET = "INTERVAL 9 HOURS"
_ISO_DATE = r"\d{4}-\d{2}-\d{2}"
_ISO_TIME = r"[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
_ISO_ZONE = r"(Z|[+-]\d{2}:?\d{2})"
_NAIVE = rf"^{_ISO_DATE}({_ISO_TIME})?$"
_ZONED = rf"^{_ISO_DATE}{_ISO_TIME}{_ISO_ZONE}$"
_STARTS_WITH_YEAR = r"^\s*\d{4}"
_END_OF_DAY = "23:59:59"


def utc_literal(moment: str | date | datetime) -> Column:
    """A decision time as a timestamp literal; a naive moment is read as UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment.replace("Z", "+00:00"))
    elif not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.astimezone(timezone.utc))


def to_utc(value: Column) -> Column:
    """Timestamp of a text, date or timestamp column; unparsable text becomes null.

    Text must start with a year: a bare time of day would be read as today.
    The type test is a constant of the plan.
    """
    dated = (F.typeof(value) != "string") | value.cast("string").rlike(_STARTS_WITH_YEAR)
    return F.when(dated, value.try_cast("timestamp"))


def iso_z(moment: Column) -> Column:
    """ISO-8601 text in UTC with a ``Z`` suffix, microseconds only when present."""
    seconds = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(F.unix_micros(moment) % 1000000 != 0, F.date_format(moment, ".SSSSSS")).otherwise("")
    return F.concat(seconds, fraction, F.lit("Z"))


def from_jst(moment: Column) -> Column:
    return moment - F.expr(_JST_OFFSET)


def jst_text(value: Column) -> Column:
    """ISO text to UTC; text without an offset is Japanese local time."""
    text = clean(value)
    return F.when(text.rlike(_ZONED), text.try_cast("timestamp")).when(
        text.rlike(_NAIVE), from_jst(text.try_cast("timestamp"))
    )


def end_of_jst_day(day: Column) -> Column:
    """Last second of a Japanese calendar day; the text is ``yyyy-MM-dd`` or a date."""
    text = F.date_format(day.try_cast("date"), "yyyy-MM-dd")
    return from_jst(F.concat(text, F.lit(f" {_END_OF_DAY}")).try_cast("timestamp"))


def update_day(value: Column) -> Column:
    """Day of a ``yyyyMMdd`` update stamp."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def known_from_update(value: Column) -> Column:
    return end_of_jst_day(update_day(value))


def disclosure_clock(value: Column) -> Column:
    """Clock text of a disclosure time, null when its shape is unknown.

    The format follows from the shape: with colons as written, six digits as
    HHmmss, four digits as HHmm.
    """
    text = clean(value)
    return (
        F.when(text.rlike(r"^\d{1,2}:\d{1,2}(:\d{1,2})?$"), text)
        .when(text.rlike(r"^\d{6}$"), F.regexp_replace(text, r"^(..)(..)(..)$", "$1:$2:$3"))
        .when(text.rlike(r"^\d{4}$"), F.regexp_replace(text, r"^(..)(..)$", "$1:$2"))
    )


def known_from_disclosure(day: Column, time: Column, fallback_day: Column) -> Column:
    """Availability of a disclosure.

    An unusable time means the end of the day, which can only delay
    availability; without a usable date it is the end of the fallback day.
    """
    date = F.date_format(day.try_cast("date"), "yyyy-MM-dd")
    stamped = F.concat(date, F.lit(" "), disclosure_clock(time)).try_cast("timestamp")
    return F.coalesce(from_jst(stamped), end_of_jst_day(day), end_of_jst_day(fallback_day))


def known_from_filing(submitted: Column, operated: Column, observed: Column, processed: Column | None = None) -> Column:
    """Later of submission and operation time, else the provider's process time, else ours."""
    candidates = [F.greatest(jst_text(submitted), jst_text(operated))]
    if processed is not None:
        candidates.append(jst_text(processed))
    return F.coalesce(*candidates, observed)
