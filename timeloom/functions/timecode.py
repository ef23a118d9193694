"""Timecodes as SQL expressions: parsing to and formatting of milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted forms, [H:]MM:SS and bare seconds, each with an optional fraction.
CLOCK = r"^(?:(\d+):)?(\d{1,2}):(\d{1,2})(?:\.(\d{1,3}))?$"
SECONDS = r"^(\d+)(?:\.(\d{1,3}))?$"


def _number(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("0")).try_cast("bigint")


def parse_timecode(value: Column) -> Column:
    """Milliseconds of a timecode; null where it is null, unreadable or too large for 64 bits."""
    text = F.regexp_replace(value, r"^(?U:\s)+|(?U:\s)+$", "")
    parts = lambda pattern, n: [F.regexp_extract(text, pattern, i) for i in range(1, n + 1)]
    h, m, s, clock_fraction = parts(CLOCK, 4)
    bare, bare_fraction = parts(SECONDS, 2)

    def millis(seconds: Column, fraction: Column) -> Column:
        return F.try_add(F.try_multiply(seconds, F.lit(1000)), F.rpad(fraction, 3, "0").try_cast("bigint"))

    clock = millis(F.try_add(F.try_multiply(_number(h), F.lit(3600)), _number(m) * 60 + _number(s)), clock_fraction)
    return F.when(text.rlike(CLOCK), clock).when(text.rlike(SECONDS), millis(_number(bare), bare_fraction))


def parse_timecode_strict(value: Column) -> Column:
    """Like :func:`parse_timecode`, but an unreadable timecode is an error; null stays null."""
    said = F.concat(F.lit("cannot parse timecode: "), value)
    return F.when(value.isNotNull() & parse_timecode(value).isNull(), F.raise_error(said).cast("bigint")).otherwise(parse_timecode(value))


def parse_range(begin: Column, end: Column) -> Column:
    """struct(t_ms_start, t_ms_end); an error where the end is not after the start."""
    low, high = parse_timecode_strict(begin), parse_timecode_strict(end)
    bad = F.raise_error(F.concat(F.lit("range ends before it starts: "), begin, F.lit(" to "), end))
    return F.struct(low.alias("t_ms_start"), F.when(high > low, high).otherwise(bad.cast("bigint")).alias("t_ms_end"))


def _hms(t_ms: Column) -> tuple[Column, Column, Column]:
    total = F.expr("0") if t_ms is None else F.floor(F.greatest(t_ms, F.lit(0)) / 1000).cast("bigint")
    return F.floor(total / 3600).cast("bigint"), F.floor(F.pmod(total, F.lit(3600)) / 60).cast("bigint"), F.pmod(total, F.lit(60))


def format_timecode(t_ms: Column) -> Column:
    """``MM:SS``, or ``H:MM:SS`` from an hour on; milliseconds are cut off and negatives are 0."""
    h, m, s = _hms(t_ms)
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).when(t_ms.isNotNull(), F.format_string("%02d:%02d", m, s))


def format_stamp(t_ms: Column) -> Column:
    """``14m02s``, or ``1h14m02s`` from an hour on, for file names."""
    h, m, s = _hms(t_ms)
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, s)).when(t_ms.isNotNull(), F.format_string("%02dm%02ds", m, s))
