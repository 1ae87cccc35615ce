"""Scalar idioms shared by the builders: Column in, Column out, nothing row-at-a-time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Range of the calendar, floor of plausible dates, words of billable time.
CALENDAR_FIRST, CALENDAR_LAST = date(2015, 1, 1), date(2035, 12, 31)
DATE_FLOOR = date(1990, 1, 1)
BILLABLE = ("BILLABLE", "HASBEENBILLED")


def norm_key(c: Column) -> Column:
    """Letters and digits only, in capitals; '' for null."""
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]", ""))


def text_or(c: Column, other: str) -> Column:
    """The trimmed text, or ``other`` where it is null or blank."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(other))


def iso_date(c: Column) -> Column:
    """Date of the first ten characters; null where they are none."""
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")


def iso_date_floor(c: Column, floor: date = DATE_FLOOR) -> Column:
    """As iso_date, and null below the floor, where source systems put their sentinels."""
    d = iso_date(c)
    return F.when(d >= F.lit(floor), d)


def in_calendar(d: Column, first: date = CALENDAR_FIRST, last: date = CALENDAR_LAST) -> Column:
    return d.between(F.lit(first), F.lit(last))


def month_key(d: Column, first: date = CALENDAR_FIRST, last: date = CALENDAR_LAST) -> Column:
    """First of the month, null outside the calendar."""
    return F.when(in_calendar(d, first, last), F.trunc(d, "MM"))


def out_of_range(d: Column, null_is_out: bool = False, first: date = CALENDAR_FIRST, last: date = CALENDAR_LAST) -> Column:
    return F.coalesce(~in_calendar(d, first, last), F.lit(null_is_out))


def aging_bucket(as_of: date, due: Column) -> Column:
    """Bucket of the days a due date lies back."""
    days = F.datediff(F.lit(as_of), due)
    return (
        F.when(due.isNull(), "Unknown").when(days <= 0, "Current").when(days <= 30, "1-30")
        .when(days <= 60, "31-60").when(days <= 90, "61-90").otherwise("90+")
    )


def aging_sort(bucket: Column) -> Column:
    order = {"Current": 1, "1-30": 2, "31-60": 3, "61-90": 4, "90+": 5}
    out = F.when(F.lit(False), 0)
    for b, n in order.items():
        out = out.when(bucket == b, n)
    return out.otherwise(9)


def length_affinity(a: Column, b: Column) -> Column:
    """Shorter length over longer, to two places; 0 for two empty texts."""
    la, lb = F.length(a), F.length(b)
    return F.round((la + lb - F.abs(la - lb)) / (2.0 * F.greatest(la, lb, F.lit(1))), 2)


def json_bool_str(c: Column) -> Column:
    return F.lower(F.trim(c)) == "true"


def hours(h: Column, m: Column) -> Column:
    return h + m / 60.0


def signed(amount: Column, header_sign: Column, posting: Column) -> Column:
    return amount * header_sign * F.when(posting == "Credit", -1.0).otherwise(1.0)


def is_billable(c: Column) -> Column:
    return F.coalesce(F.upper(c).isin(*BILLABLE), F.lit(False))


def safe_ratio(n: Column, d: Column, otherwise: float | None = 0.0) -> Column:
    """n over d, and ``otherwise`` where d is zero or null."""
    return F.when(d != 0, n / d).otherwise(F.lit(otherwise).cast("double"))


def unless_present(value: Column, derived: Column) -> Column:
    """The value where it is set and not zero, the derived one elsewhere."""
    return F.when(value != 0, value).otherwise(derived)


def money(c: Column) -> Column:
    """A money text as double, 0 where it is missing or unreadable."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def json_path(payload: Column, *path: str) -> Column:
    """A member of a JSON text, every step in brackets so that names may hold blanks."""
    return F.get_json_object(payload, "$" + "".join(f"['{p}']" for p in path))


def row_hash(*columns: str) -> Column:
    """sha256 of the columns' JSON, sorted by name, so that column order doesn't matter."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)
