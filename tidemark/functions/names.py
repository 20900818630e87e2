"""Names and bounds of partitions, and sequence arithmetic; for the driver and as columns."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longest identifier of the target, in bytes of UTF-8 (a fixed value).
LONGEST = 63
RANGE_FORMATS = {"daily": "{table}_{yyyy}_{mm}_{dd}", "monthly": "{table}_{yyyy}_{mm}"}
DEFAULT_FORMAT, LIST_FORMAT = "{table}_default", "{table}_{value}"


def bounded_identifier(name: str) -> str:
    """The name, or if it is too long its beginning and twelve hex digits of its SHA-256."""
    raw = name.encode("utf-8")
    if len(raw) <= LONGEST:
        return name
    tail = "_" + hashlib.sha256(raw).hexdigest()[:12]
    return raw[: LONGEST - len(tail)].decode("utf-8", "ignore") + tail


def as_date(value: Any) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    raise TypeError(f"a date or timestamp is needed, not {type(value).__name__}")


def period_start(day: date, granularity: str) -> date:
    if granularity not in RANGE_FORMATS:
        raise ValueError(f"no such granularity: {granularity}")
    return day.replace(day=1) if granularity == "monthly" else day


def next_period(start: date, granularity: str) -> date:
    if granularity == "monthly":
        return (start.replace(day=28) + timedelta(days=4)).replace(day=1)
    return start + timedelta(days=1)


def range_format(granularity: str, form: str | None = None) -> str:
    """The form of range names, which must tell any two periods apart."""
    form = form or RANGE_FORMATS[granularity]
    need = ("yyyymmdd",) if granularity == "daily" else ("yyyymm", "yyyymmdd")
    split = ("yyyy", "mm", "dd") if granularity == "daily" else ("yyyy", "mm")
    if not any(f"{{{n}}}" in form for n in need) and not all(f"{{{n}}}" in form for n in split):
        raise ValueError(f"partition name format {form!r} does not tell {granularity} periods apart")
    return form


def range_name(table: str, start: date, granularity: str, form: str | None = None) -> str:
    parts = {"yyyy": f"{start:%Y}", "mm": f"{start:%m}", "dd": f"{start:%d}", "yyyymm": f"{start:%Y%m}", "yyyymmdd": f"{start:%Y%m%d}"}
    return bounded_identifier(range_format(granularity, form).format(table=table, **parts))


def safe_suffix(value: Any) -> str:
    return str(value).translate(str.maketrans("- :.", "____"))


def list_format(form: str | None = None) -> str:
    form = form or LIST_FORMAT
    if "{value}" not in form:
        raise ValueError(f"partition name format {form!r} lacks {{value}}")
    return form


def list_name(table: str, value: Any, form: str | None = None) -> str:
    return bounded_identifier(list_format(form).format(table=table, value=safe_suffix(value)))


def default_name(table: str, form: str | None = None) -> str:
    return bounded_identifier((form or DEFAULT_FORMAT).format(table=table))


def period_column(column: str, granularity: str) -> Column:
    day = F.col(column).cast("date")
    return F.trunc(day, "MM") if granularity == "monthly" else day


def next_period_column(start: Column, granularity: str) -> Column:
    return F.add_months(start, 1) if granularity == "monthly" else F.date_add(start, 1)


def bounded_column(name: Column) -> Column:
    """``bounded_identifier`` of a column."""
    head = F.regexp_replace(F.decode(F.substring(name.cast("binary"), 1, LONGEST - 13), "UTF-8"), "\ufffd$", "")
    return F.when(F.octet_length(name) <= LONGEST, name).otherwise(F.concat(head, F.lit("_"), F.left(F.sha2(name, 256), F.lit(12))))


def range_name_column(table: str, start: Column, granularity: str, form: str | None = None) -> Column:
    name = F.lit(range_format(granularity, form).replace("{table}", table))
    for part, pattern in (("{yyyymmdd}", "yyyyMMdd"), ("{yyyymm}", "yyyyMM"), ("{yyyy}", "yyyy"), ("{mm}", "MM"), ("{dd}", "dd")):
        name = F.replace(name, F.lit(part), F.date_format(start, pattern))
    return bounded_column(name)


def list_name_column(table: str, value: Column, form: str | None = None) -> Column:
    return bounded_column(F.replace(F.lit(list_format(form).replace("{table}", table)), F.lit("{value}"), safe_suffix_column(value)))


def safe_suffix_column(value: Column) -> Column:
    return F.translate(value.cast("string"), "- :.", "____")


@dataclass(frozen=True)
class Sequence:
    next_value: int
    increment: int = 1
    least: int = 1
    most: int = 2**63 - 1

    def after(self, table_value: int | None) -> "Sequence":
        """The sequence once the table's extreme value is behind it; it never moves backwards."""
        if table_value is None:
            return self
        nxt = table_value + self.increment
        better = max(nxt, self.next_value) if self.increment > 0 else min(nxt, self.next_value)
        return Sequence(better, self.increment, self.least, self.most)

    @staticmethod
    def read(last_value: int, is_called: bool, increment: int = 1, least: int = 1, most: int = 2**63 - 1) -> "Sequence":
        return Sequence(last_value + increment if is_called else last_value, increment, least, most)

    def stored(self) -> tuple[int, bool]:
        """What to store: the value before, as already given out, unless it is out of bounds."""
        before = self.next_value - self.increment
        return (before, True) if self.least <= before <= self.most else (self.next_value, False)
