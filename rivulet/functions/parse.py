"""Parsing text fields into typed values (ANSI strict by default, lenient on request)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.text import java_split

# Fixed value: the text layout of an action time, ``yyyy-MM-dd HH:mm:ss`` (UTC wall clock).
ACTION_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

_INT_TEXT = r"\A[+-]?[0-9]+\z"  # \z: a final line end is not allowed either


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(text, strict: bool = True) -> Column:
    """Decimal text to ``int`` like ``Integer.parseInt``.

    Strict: an optional sign and digits only (no blanks -- Spark's cast alone would accept
    ``' 12 '``); anything else, or an int overflow, fails the query.  Lenient: null instead.
    """
    text = _col(text)
    if not strict:
        return F.when(text.rlike(_INT_TEXT), text.try_cast("int"))
    bad = F.raise_error(F.concat(F.lit("not a decimal int: '"), F.coalesce(text, F.lit("null")), F.lit("'")))
    return F.when(text.rlike(_INT_TEXT), text.cast("int")).otherwise(bad.cast("int"))


def delimited_field(text, sep: str, index: int, strict: bool = True) -> Column:
    """Field ``index`` (0-based) of ``text`` cut at ``sep``; a missing field fails when strict."""
    parts = java_split(text, sep)
    return F.element_at(parts, index + 1) if strict else F.get(parts, index)


def to_action_time(text, fmt: str = ACTION_TIME_FORMAT, strict: bool = True) -> Column:
    """Text time to ``timestamp_ntz`` (wall clock, zone-free); strict raises on bad text."""
    if strict:
        return F.to_timestamp_ntz(_col(text), F.lit(fmt))
    return F.try_to_timestamp(_col(text), F.lit(fmt)).cast("timestamp_ntz")


def to_event_time(ts) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` (the type watermarks need) in the session zone (UTC)."""
    return _col(ts).cast("timestamp")


def str_to_millis(text, fmt: str = ACTION_TIME_FORMAT) -> Column:
    """Text time (UTC) to epoch milliseconds, ``bigint``."""
    return F.unix_millis(F.to_timestamp(_col(text), fmt))


_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def duration_us(duration: str) -> int:
    """``'6 hours'``, ``'1 second'``, ``'1 minute 30 seconds'`` -> microseconds."""
    parts = duration.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"bad duration {duration!r}")
    total = 0
    for num, unit in zip(parts[::2], parts[1::2]):
        unit = unit.lower().rstrip("s")
        if unit not in _UNIT_US:
            raise ValueError(f"bad duration unit in {duration!r}")
        total += int(float(num) * _UNIT_US[unit])
    return total
