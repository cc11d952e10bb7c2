"""Date parsing, whole months and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def _first(c: Column, *tries: tuple[str, str]) -> Column:
    """The first pattern whose shape fits and that parses; shapes keep lenient parsers apart."""
    t = strip(c)
    return F.coalesce(*[F.when(t.rlike(shape), F.try_to_date(t, pattern)) for shape, pattern in tries])


DMY, YMD, SLASH = (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy")
LONG, SHORT = (r"^\d{1,2} [A-Za-z]{3,9} \d{4}$", "d MMMM yyyy"), (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy")


def snapshot_date(c: Column) -> Column:
    """Day-first or year-first with dashes."""
    return _first(c, DMY, YMD)


def register_date(c: Column) -> Column:
    return _first(c, SLASH, YMD, DMY)


def iso_date(c: Column) -> Column:
    """ISO dates and date-times, with or without a trailing Z."""
    t = F.regexp_replace(c, "Z$", "")
    return F.coalesce(F.when(t.rlike(YMD[0]), F.try_to_date(t, YMD[1])), F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"), F.to_date(F.try_to_timestamp(t, F.lit("yyyy-M-d'T'H:m:s")))))


def scraped_date(c: Column) -> Column:
    return _first(c, LONG, SHORT, SLASH, YMD, DMY)


def any_date(c: Column) -> Column:
    """All of the above, and yyyyMMdd."""
    return _first(c, YMD, SLASH, DMY, (r"^\d{8}$", "yyyyMMdd"), LONG, SHORT)


def whole_months(end: Column, start: Column) -> Column:
    """Full calendar months from start to end, negative where end is earlier."""

    def forward(e, s):
        return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s) - (F.dayofmonth(e) < F.dayofmonth(s)).cast("int")

    return F.when(end >= start, forward(end, start)).when(end < start, -forward(start, end))


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def year_quarter(c: Column) -> Column:
    return F.date_format(c, "yyyy-'Q'Q")


def months_before(c: Column, n: int) -> Column:
    return F.add_months(c, -n)
