"""Scalar text functions of the renderers, in Spark and in SQL. Times are whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(ms: Column, unit: int, base: int | None = None) -> Column:
    n = F.floor(ms / unit)
    return (n if base is None else n % base).cast("bigint")


def clock(ms: Column) -> Column:
    """HH:MM:SS, cut off."""
    return F.format_string("%02d:%02d:%02d", _part(ms, 3_600_000), _part(ms, 60_000, 60), _part(ms, 1000, 60))


def srt_time(ms: Column) -> Column:
    """HH:MM:SS,mmm."""
    return F.format_string("%02d:%02d:%02d,%03d", _part(ms, 3_600_000), _part(ms, 60_000, 60), _part(ms, 1000, 60), (ms % 1000).cast("bigint"))


def short_clock(ms: Column) -> Column:
    """MM:SS, with hours before where there are any."""
    h = _part(ms, 3_600_000)
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, _part(ms, 60_000, 60), _part(ms, 1000, 60))).otherwise(minutes(ms))


def minutes(ms: Column) -> Column:
    """MM:SS with as many minutes as there are."""
    return F.format_string("%02d:%02d", _part(ms, 60_000), _part(ms, 1000, 60))


def sentences(text: Column) -> Column:
    """Cut behind . ! ? and white space; blank parts left out."""
    return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")) != "")


def shorten(text: Column, width: int, tail: str = "...") -> Column:
    return F.when(F.char_length(text) > width, F.concat(F.substring(text, 1, width), F.lit(tail))).otherwise(text)


def clock_sql(ms: str) -> str:
    return f"printf('%02d:%02d:%02d', CAST({ms} // 3600000 AS BIGINT), CAST(({ms} // 60000) % 60 AS BIGINT), CAST(({ms} // 1000) % 60 AS BIGINT))"


def srt_time_sql(ms: str) -> str:
    return f"printf('%02d:%02d:%02d,%03d', CAST({ms} // 3600000 AS BIGINT), CAST(({ms} // 60000) % 60 AS BIGINT), CAST(({ms} // 1000) % 60 AS BIGINT), CAST({ms} % 1000 AS BIGINT))"


def minutes_sql(ms: str) -> str:
    return f"printf('%02d:%02d', CAST({ms} // 60000 AS BIGINT), CAST(({ms} // 1000) % 60 AS BIGINT))"


def short_clock_sql(ms: str) -> str:
    return f"CASE WHEN {ms} >= 3600000 THEN printf('%d:%02d:%02d', CAST({ms} // 3600000 AS BIGINT), CAST(({ms} // 60000) % 60 AS BIGINT), CAST(({ms} // 1000) % 60 AS BIGINT)) ELSE {minutes_sql(ms)} END"


SENTENCES_SQL = "list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g')) <> '')"
