"""Timestamps from loosely typed input.

All results are TIMESTAMP_NTZ, so they do not depend on the session time zone. The type of the
column picks the rule; the values never do. So an integer date column with nulls stays an integer
date column, and is not read as spreadsheet serial numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerflow.functions.text import as_column

# The digits each strptime field accepts, longest choice first.
MONTH = "(1[0-2]|0[1-9]|[1-9])"
DAY = "(3[01]|[12][0-9]|0[1-9]|[1-9])"
HOUR = "(2[0-3]|[01][0-9]|[0-9])"
MINUTE = "([0-5][0-9]|[0-9])"
SECOND = "(6[01]|[0-5][0-9]|[0-9])"
YEAR = "([0-9]{4})"
SHORT_YEAR = "([0-9]{2})"

SPACES = " \t\n\r\x0b\x0c"

SERIAL_START, SERIAL_MIN = "1899-12-30 00:00:00", 59.0


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _seconds(value: Column) -> Column:
    """An interval of decimal seconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), value.try_cast("decimal(18,6)"))


def _read(
    text: Column,
    pattern: str,
    order: str,
    second: int | None = None,
    sizes: tuple[int, int] | None = None,
) -> Column:
    """Rearrange ``text`` to ISO order and cast.

    Seconds are added on top, so that 60 and 61 run into the next minute. ``sizes`` are the text
    lengths the pattern can match; others are not tried.
    """
    moment = F.regexp_replace(text, pattern, order).try_cast("timestamp_ntz")
    if second is not None:
        moment = moment + _seconds(F.regexp_extract(text, pattern, second))
    fits = text.rlike(pattern)
    return F.when(F.length(text).between(*sizes) & fits if sizes else fits, moment)


def timestamp_from_text(c: Column | str) -> Column:
    """First layout that fits the trimmed text, else NULL.

    ``yyyy/MM/dd HH:mm:ss``, ``yyyy-MM-dd HH:mm:ss``, ``yyyyMMdd``, ``yyyyMMddHHmmss``, then
    ``yyyy/MM/dd`` and ``yyyy-MM-dd``.
    """
    text = F.btrim(as_column(c), F.lit(SPACES))
    # The common form needs no rearranging; odd seconds and single digits go the longer way.
    usual = "^[0-9]{4}([-/])[0-9]{2}\\1[0-9]{2} [0-9]{2}:[0-9]{2}:[0-5][0-9]$"
    common = F.when(
        (F.length(text) == 19) & text.rlike(usual),
        F.translate(text, "/", "-").try_cast("timestamp_ntz"),
    )
    separated = f"^{YEAR}([-/]){MONTH}\\2{DAY} {HOUR}:{MINUTE}:{SECOND}$"
    digits_day = f"^{YEAR}{MONTH}{DAY}$"
    digits_time = f"^{YEAR}{MONTH}{DAY}{HOUR}{MINUTE}{SECOND}$"
    day_only = "^([0-9]{4})([-/])([0-9]{2})\\2([0-9]{2})$"
    return F.coalesce(
        common,
        _read(text, separated, "$1-$3-$4 $5:$6:00", 7, sizes=(14, 19)),
        _read(text, digits_day, "$1-$2-$3", sizes=(6, 8)),
        _read(text, digits_time, "$1-$2-$3 $4:$5:00", 6, sizes=(9, 14)),
        _read(text, day_only, "$1-$3-$4", sizes=(10, 10)),
    )


def _full_year(short: Column) -> Column:
    """Two-digit years: 69 to 99 are 19xx, the rest 20xx."""
    return F.when(short.cast("int") >= 69, F.concat(F.lit("19"), short)).otherwise(
        F.concat(F.lit("20"), short)
    )


def timestamp_from_integer(c: Column | str) -> Column:
    """By digit count: 8 ``yyyyMMdd``, 6 ``yyMMdd``, 12 ``yyyyMMddHHmm``, 14 ``yyyyMMddHHmmss``.

    Any other length counts nanoseconds since 1970. Numbers that name no real date give NULL.
    """
    number = as_column(c).cast("bigint")
    text = number.cast("string")
    with_year = F.concat(_full_year(F.substring(text, 1, 2)), F.substring(text, 3, 4))
    day = f"^{YEAR}{MONTH}{DAY}$"
    minute = f"^{YEAR}{MONTH}{DAY}{HOUR}{MINUTE}$"
    second = f"^{YEAR}{MONTH}{DAY}{HOUR}{MINUTE}{SECOND}$"
    micros = (number - F.pmod(number, F.lit(1000))).cast("decimal(20,0)") / F.lit(1000000000)
    size = F.length(text)
    return (
        F.when(size == 8, _read(text, day, "$1-$2-$3"))
        .when(size == 6, _read(with_year, day, "$1-$2-$3"))
        .when(size == 12, _read(text, minute, "$1-$2-$3 $4:$5:00"))
        .when(size == 14, _read(text, second, "$1-$2-$3 $4:$5:00", 6))
        .otherwise(_epoch() + _seconds(micros))
    )


def timestamp_from_serial(c: Column | str) -> Column:
    """Spreadsheet day numbers above 59, counted from 1899-12-30; the fraction is the time."""
    serial = as_column(c).cast("double")
    start = F.lit(SERIAL_START).cast("timestamp_ntz")
    moved = start + _seconds(F.round(serial * F.lit(86400.0), 6))
    return F.when(serial > SERIAL_MIN, moved)


def timestamp_from_log(c: Column | str) -> Column:
    """``dd/MM/yy HH.mm.ss`` text, else NULL."""
    text = as_column(c)
    second = "([0-5][0-9]|[0-9])"
    pattern = f"^{DAY}/{MONTH}/{SHORT_YEAR} {HOUR}\\.{MINUTE}\\.{second}\\z"
    year = _full_year(F.regexp_extract(text, pattern, 3))
    rest = F.regexp_replace(text, pattern, "-$2-$1 $4:$5:$6")
    return F.when(text.rlike(pattern), F.concat(year, rest).try_cast("timestamp_ntz"))


def date_from_page_header(c: Column | str) -> Column:
    """``MM/dd/yy`` of a report page header."""
    text = as_column(c)
    pattern = f"^{MONTH}/{DAY}/{SHORT_YEAR}\\z"
    year = _full_year(F.regexp_extract(text, pattern, 3))
    rest = F.regexp_replace(text, pattern, "-$1-$2")
    return F.when(text.rlike(pattern), F.concat(year, rest).try_cast("date"))
