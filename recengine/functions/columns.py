"""Column expressions (all built-in, JVM-side; no Python UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lifecycle labels the catalogue uses, in test order
# (ongoing, ended, upcoming, unknown).
STATUS_ONGOING = "课程进行中"
STATUS_ENDED = "课程已结束"
STATUS_UPCOMING = "课程即将开始"
STATUS_UNKNOWN = "未知"
STATUS_LABELS = (STATUS_ONGOING, STATUS_ENDED, STATUS_UPCOMING, STATUS_UNKNOWN)

# The CJK date markers (year, month, day) of the catalogue's date text.
DATE_MARK_YEAR = "年"
DATE_MARK_MONTH = "月"
DATE_MARK_DAY = "日"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_lit(as_of: Column | str | _dt.datetime | _dt.date | None) -> Column:
    """A timestamp literal in the session time zone; ``None`` means the query's current time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    # wall-clock text cast in the session time zone, like a SQL timestamp literal (a naive
    # Python datetime would be converted with the process's zone instead)
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    if isinstance(as_of, _dt.date):
        return F.lit(as_of.strftime("%Y-%m-%d 00:00:00")).cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def parse_cjk_date(c: Column | str) -> Column:
    """Parse 'yyyy年M月d日' text (also plain 'yyyy-M-d') to a date; null when malformed.

    The markers are turned into dashes and the text is cast with ``try_cast``, so a bad
    value gives null instead of failing the query under ANSI mode.
    """
    text = _col(c)
    dashed = F.replace(F.replace(F.replace(text, F.lit(DATE_MARK_YEAR), F.lit("-")),
                                 F.lit(DATE_MARK_MONTH), F.lit("-")),
                       F.lit(DATE_MARK_DAY), F.lit(""))
    return dashed.try_cast("date")


def lifecycle_status(start: Column | str, end: Column | str, as_of=None,
                     labels: tuple[str, str, str, str] = STATUS_LABELS) -> Column:
    """Status of a course at ``as_of``: ongoing, ended, upcoming, else unknown.

    Tested in this order: start < t < end -> ongoing; end < t -> ended; start > t ->
    upcoming; anything else (a bound equal to t, a null date) -> unknown. Dates compare
    with the timestamp at midnight.
    """
    s, e, t = _col(start), _col(end), timestamp_lit(as_of)
    ongoing, ended, upcoming, unknown = labels
    return (F.when((s < t) & (e > t), F.lit(ongoing))
            .when(e < t, F.lit(ended))
            .when(s > t, F.lit(upcoming))
            .otherwise(F.lit(unknown)))


def text_contains(text: Column | str, part: Column | str) -> Column:
    """``instr(text, part) > 0`` with a null result mapped to false."""
    return F.coalesce(F.instr(_col(text), _col(part)) > 0, F.lit(False))


def nulls_one(c: Column | str, approx: bool = False, rsd: float = 0.01) -> Column:
    """Number of distinct values of ``c`` counting null as one value (an aggregate).

    ``approx`` uses HyperLogLog++ (``approx_count_distinct`` with relative error ``rsd``),
    which needs no shuffle of the distinct values.
    """
    x = _col(c)
    distinct = F.approx_count_distinct(x, rsd) if approx else F.count_distinct(x)
    return (distinct + F.coalesce(F.max(x.isNull().cast("int")), F.lit(0))).cast("bigint")
