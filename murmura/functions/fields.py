"""Columns that read one field out of a captured post."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmura.functions.text import WORD

# What counts as a mention, a tag and an abbreviated number.
MENTION = r"@([A-Za-z0-9_]{1,15})"
HASHTAG = rf"#({WORD}+)"
HASHTAG_WITH_MARKS = r"(?U)#(\w+)"
COUNT = r"(?U)([\d.]+)\s*([KkMm])?"
COUNT_STRICT = r"(?U)([\d.]+)\s*([KkMm](?!\p{L}))?"
STATUS_PART = "/status/"

_DIGITS = [chr(i) for i in range(128, sys.maxunicode + 1) if chr(i).isdecimal()]
_DIGIT_VALUES = "".join(str(unicodedata.decimal(d)) for d in _DIGITS)


def is_post_link(permalink: Column) -> Column:
    return F.coalesce(permalink.contains(STATUS_PART), F.lit(False))


def post_id(permalink: Column) -> Column:
    """Last path segment, ignoring trailing slashes."""
    return F.substring_index(F.rtrim(permalink, F.lit("/")), "/", -1)


def username(user_block: Column) -> Column:
    """First line that starts with ``@``, without it; else the first line; else empty."""
    lines = F.split(user_block, "\n")
    handle = F.get(F.filter(lines, lambda line: line.startswith("@")), F.lit(0))
    return F.coalesce(F.substr(handle, F.lit(2)), F.get(lines, F.lit(0)), F.lit(""))


def parse_count(label: Column, strict_suffix: bool = False) -> Column:
    """``1,234`` / ``1.2K`` / ``3m`` to a whole number; anything unreadable is 0.

    By default a suffix letter counts even inside a word (``12 minutes`` is 12 million), as in
    the data this reproduces; ``strict_suffix`` wants it to stand alone.
    """
    ascii_digits = F.when(
        label.rlike(r"[^\x00-\x7F]"), F.translate(label, "".join(_DIGITS), _DIGIT_VALUES)
    ).otherwise(label)
    text = F.replace(ascii_digits, F.lit(","), F.lit(""))
    pattern = COUNT_STRICT if strict_suffix else COUNT
    number = F.regexp_extract(text, pattern, 1).try_cast("double")
    suffix = F.lower(F.regexp_extract(text, pattern, 2))
    factor = F.when(suffix == "k", 1e3).when(suffix == "m", 1e6).otherwise(1.0)
    return F.coalesce((number * factor).try_cast("bigint"), F.lit(0).cast("bigint"))


def mentions(content: Column) -> Column:
    return F.regexp_extract_all(content, F.lit(MENTION), F.lit(1))


def hashtags(content: Column, with_marks: bool = False) -> Column:
    """Lower-cased tags. ``with_marks`` keeps the combining marks of Indic scripts inside a tag."""
    pattern = HASHTAG_WITH_MARKS if with_marks else HASHTAG
    return F.transform(F.regexp_extract_all(content, F.lit(pattern), F.lit(1)), F.lower)


def int_or_zero(c: Column) -> Column:
    """Whole number of a text; floats are cut, null, empty and unreadable text is 0."""
    text = c.cast("string")
    # A text with a point is no whole number; the cast would find that out by an exception.
    exact = F.when(~text.contains("."), text.try_cast("bigint"))
    cut = text.try_cast("double").try_cast("bigint")
    return F.coalesce(exact, cut, F.lit(0).cast("bigint"))


def is_bad_number(c: Column) -> Column:
    """Text that `int_or_zero` could not read."""
    text = c.cast("string")
    return text.isNotNull() & (text != "") & text.try_cast("double").isNull()


# A date, and times of day; those in `ZONED` have an offset or zone behind them.
DATE = r"^[+-]?\d{4,}-\d{1,2}-\d{1,2}"
SECONDS, MINUTES, ZONED = rf"{DATE}[T ]\d{{1,2}}:\d{{1,2}}:[\d.]+$", rf"{DATE}[T ]\d{{1,2}}:\d{{1,2}}$", rf"{DATE}[T ][\d:.]+ ?[A-Za-z+-]"
DAY_MICROS = 86_400_000_000


def parse_timestamp(c: Column) -> Column:
    """UTC instant of a text with or without an offset; unreadable text is null.

    A time without an offset is read as UTC whatever the session's time zone: the text is completed before
    it is read. Without a whole date it is unreadable.
    """
    text = F.trim(c)
    whole = (
        F.when(text.rlike(SECONDS), F.concat(text, F.lit("Z")))
        .when(text.rlike(ZONED), text)
        .when(text.rlike(MINUTES), F.concat(text, F.lit(":00Z")))
        .when(text.rlike(DATE + "$"), F.concat(text, F.lit("T00:00:00Z")))
    )
    return whole.try_cast("timestamp")


def _day_start(c: Column) -> Column:
    micros = F.unix_micros(c)
    return micros - F.pmod(micros, F.lit(DAY_MICROS))


def utc_day(c: Column) -> Column:
    """Midnight UTC of the day of an instant."""
    return F.timestamp_micros(_day_start(c))


def utc_date(c: Column) -> Column:
    """The UTC date of an instant, like ``2026-01-31``."""
    return F.date_from_unix_date((_day_start(c) / DAY_MICROS).cast("int")).cast("string")
