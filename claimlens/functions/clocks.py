"""Instants, calendar days, partial dates and quarters as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp, read as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def clock_us(text: Column) -> Column:
    """Microseconds of an instant in text; null when it names no zone or cannot be read."""
    zoned = text.rlike(r"(?:[Zz]|[+-]\d{2}:?\d{2})\z")
    return F.when(zoned, F.unix_micros(F.try_to_timestamp(text)))


def iso_utc(us: Column) -> Column:
    """ISO text of an instant in UTC; a zero fraction is left out."""
    base = F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss")
    part = F.pmod(us, F.lit(1_000_000))
    return F.concat(base, F.when(part != 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def add_quarters(day: Column, n: Column | int) -> Column:
    return F.add_months(quarter_start(day), (n if isinstance(n, Column) else F.lit(n)) * 3)


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def quarter_offset(start: Column, target: Column) -> Column:
    return (F.year(target) - F.year(start)) * 4 + F.quarter(target) - F.quarter(start)


def is_calendar_quarter(start: Column, end: Column) -> Column:
    """Whether [start, end) is exactly one calendar quarter."""
    return (quarter_start(start) == start) & (end == F.add_months(start, 3))


def partial_date(text: Column) -> tuple[Column, Column, Column]:
    """(first day, last day, precision) of YYYY, YYYY-MM, YYYY-MM-DD, YYYY-Qn or YYYY-Hn; nulls for anything else."""
    year = F.substring(text, 1, 4).cast("int")
    unit = F.substring(text, 7, 1).cast("int")
    kind = (
        F.when(text.rlike(r"^\d{4}\z"), "year")
        .when(text.rlike(r"^\d{4}-(0[1-9]|1[0-2])\z"), "month")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z") & F.try_to_date(text).isNotNull(), "day")
        .when(text.rlike(r"^\d{4}-Q[1-4]\z"), "quarter")
        .when(text.rlike(r"^\d{4}-H[12]\z"), "half")
    )
    first = (
        F.when(kind == "year", F.make_date(year, F.lit(1), F.lit(1)))
        .when(kind == "month", F.make_date(year, F.substring(text, 6, 2).cast("int"), F.lit(1)))
        .when(kind == "day", F.try_to_date(text))
        .when(kind == "quarter", F.make_date(year, unit * 3 - 2, F.lit(1)))
        .when(kind == "half", F.make_date(year, unit * 6 - 5, F.lit(1)))
    )
    months = F.when(kind == "year", 12).when(kind == "month", 1).when(kind == "quarter", 3).when(kind == "half", 6)
    last = F.when(kind == "day", first).otherwise(F.date_sub(F.add_months(first, months), 1))
    return first, last, kind


def published_by(published: Column, retrieved: Column) -> Column:
    """Publication not after retrieval, at the precision that the publication has: a day or an instant."""
    day = F.try_to_date(published)
    return F.when(F.length(published) == 10, day <= F.to_date(retrieved)).otherwise(F.try_to_timestamp(published) <= retrieved)


def publisher_date(text: Column) -> Column:
    """The day of DD-MON-YY in this century; null for anything else."""
    months = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
    month = F.array_position(F.array(*[F.lit(m) for m in months]), F.substring(text, 4, 3))
    iso = F.format_string("20%s-%02d-%s", F.substring(text, 8, 2), month, F.substring(text, 1, 2))
    return F.when(text.rlike(r"\A\d{2}-[A-Z]{3}-\d{2}\z") & (month > 0), F.try_to_date(iso))


def local_day(us: Column, hours: int) -> Column:
    """The calendar day of an instant where clocks stand `hours` ahead of UTC."""
    return F.to_date(F.timestamp_micros(us + F.lit(hours * 3_600_000_000)))


def literal_period(text: Column) -> tuple[Column, Column]:
    """(first, last day) of a bare year or of its first or second half in words; nulls for anything else."""
    rule = r"\A(?:(first|second) half of )?(20\d{2})\z"
    half, year = F.regexp_extract(text, rule, 1), F.regexp_extract(text, rule, 2).try_cast("int")
    low = F.make_date(year, F.when(half == "second", 7).otherwise(1), F.lit(1))
    high = F.when(half == "first", F.make_date(year, F.lit(6), F.lit(30))).otherwise(F.make_date(year, F.lit(12), F.lit(31)))
    return low, high
