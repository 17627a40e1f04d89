"""Date parsing and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted layouts, tried in order: ISO date, day-first date, ISO date-time.
ISO_DATE = "yyyy-MM-dd"
DAY_FIRST = "d/M/yyyy"
_ISO_DATETIME_PREFIX = r"^\s*\d{4}-\d{2}-\d{2}[T ]"
_ISO_DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_DAY_FIRST_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4}$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c) -> Column:
    """lenient day-first parse; anything unparsable becomes null.

    Explicit formats replace pandas' guessing: ISO dates keep their meaning,
    'dd/mm/yyyy' is read day first, and an ISO timestamp keeps its date part.
    A bare year ('2024') is rejected rather than read as 1 January.
    """
    s = F.trim(_c(c))
    # Each layout is tried only on strings of its shape: a parser that fails
    # does so by raising inside the JVM, which is slow per row.
    return F.coalesce(
        F.when(s.rlike(_ISO_DATE_SHAPE), F.try_to_date(s, ISO_DATE)),
        F.when(s.rlike(_DAY_FIRST_SHAPE), F.try_to_date(s, DAY_FIRST)),
        # The date as written, whatever the session's time zone makes of the time.
        F.when(s.rlike(_ISO_DATETIME_PREFIX) & F.try_to_timestamp(s).isNotNull(),
               F.try_to_date(F.substring(s, 1, 10), ISO_DATE)),
    )


def iso_week(c) -> Column:
    """ISO-8601 week number (the 'epidemiological week' column)."""
    return F.weekofyear(_c(c))


def month_number(c) -> Column:
    """F8."""
    return F.month(_c(c))


def ano_mes(c) -> Column:
    """'yyyy-MM' label, sorts chronologically."""
    return F.date_format(_c(c), "yyyy-MM")


def mes_ano(c) -> Column:
    """'MM/yyyy' label as displayed (sorts as text, not by time)."""
    return F.date_format(_c(c), "MM/yyyy")


def days_between(end, start) -> Column:
    """whole days from start to end (date - date)."""
    return F.datediff(_c(end), _c(start))


def in_period(c, start, end) -> Column:
    """Inclusive BETWEEN on dates; a missing bound leaves that side open."""
    c = _c(c)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (c <= F.lit(end).cast("date"))
    return cond
