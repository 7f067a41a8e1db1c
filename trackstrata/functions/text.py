"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without blanks, tabs and line breaks at both ends; ``trim`` alone removes blanks only."""
    return F.btrim(_col(c), F.lit(" \t\n\r\x0b\x0c"))


def wall_clock(c: Column | str, fmt: str) -> Column:
    """Text as ``timestamp_ntz``, null where it does not parse. It is read as UTC whatever the session's zone, so an
    hour that daylight saving skips stays as written."""
    zoned = F.try_to_timestamp(F.concat(_col(c), F.lit("Z")), F.lit(fmt + "X"))
    seconds = (F.unix_micros(zoned) / F.lit(1_000_000)).cast("decimal(18,6)")
    none = F.lit(0)
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(none, none, none, seconds)


def basename(c: Column | str, lower: bool = True) -> Column:
    """The last path component, either slash kind; lower-cased by default."""
    name = F.regexp_extract(_col(c), r"[^/\\]+$", 0)
    return F.lower(name) if lower else name


def name_slug(c: Column | str, width: int = 3) -> Column:
    """``'Apis mellifera'`` -> ``'api_mel'``; a single word gives its first letters. For display: two
    names may share a slug."""
    words = F.split(strip(F.lower(_col(c))), r"\s+", 2)
    return F.concat_ws("_", F.transform(words, lambda word: F.substring(word, 1, width)))


def empty_to_null(c: Column | str) -> Column:
    """Trimmed text, with nothing left read as missing."""
    return F.nullif(strip(c), F.lit(""))


def normal_name(c: Column | str) -> Column:
    """Trimmed, lower-cased, single-spaced name for matching."""
    return F.lower(F.regexp_replace(strip(c), r"\s+", " "))
