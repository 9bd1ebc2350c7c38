"""Scalar building blocks. Every helper returns a built-in Column, so all of it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One line of money, hours, quantity or rate. Precision 18 keeps a value in one machine word
# and six decimals hold ad costs given in millionths; sums widen to decimal(28,6).
AMOUNT = T.DecimalType(18, 6)

# Date layouts the sources deliver. A single M or d accepts one or two digits.
DATE_LAYOUTS = {
    "day_mon_year": "d-MMM-yyyy",
    "slash_mdy": "M/d/yyyy",
    "compact_ymd": "yyyyMMdd",
    "dash_mdy": "M-d-yyyy",
}


def amount(c: str | Column) -> Column:
    """Strict text-to-number cast: bad text fails the job (ANSI), it never turns into null."""
    return _col(c).cast(AMOUNT)


def whole(c: str | Column) -> Column:
    """Strict text-to-integer; ``10.0`` is 10, a fraction is rounded."""
    return F.round(amount(c)).cast("int")


def parse_date(c: str | Column, kind: str) -> Column:
    """Text to DATE. ``kind`` is a key of DATE_LAYOUTS, or:

    iso         2025-04-01
    iso_prefix  the first ten characters of a datetime text
    slash_or_iso  MM/DD/YYYY where the text has that shape, else iso
    period      YYYYMM, read as the first of the month
    """
    c = _col(c)
    if kind == "iso":
        return c.cast("date")
    if kind == "iso_prefix":
        return F.substring(c, 1, 10).cast("date")
    if kind == "slash_or_iso":
        return F.when(c.like("__/__/____"), F.to_date(c, "MM/dd/yyyy")).otherwise(c.cast("date"))
    if kind == "period":
        return F.to_date(F.concat(c, F.lit("01")), "yyyyMMdd")
    return F.to_date(c, DATE_LAYOUTS[kind])


def month_of(d: str | Column) -> Column:
    return F.trunc(_col(d), "MM")


def week_of(d: str | Column) -> Column:
    """Monday of the week."""
    return F.trunc(_col(d), "WEEK")


def month_number(d: str | Column) -> Column:
    """Months since year 0: differences are whole months."""
    return F.year(_col(d)) * 12 + F.month(_col(d))


def months_apart(later: str | Column, earlier: str | Column) -> Column:
    return month_number(later) - month_number(earlier)


def month_text(d: str | Column) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def shift_month_text(c: str | Column, months: int | Column) -> Column:
    """``2025-11`` + 3 -> ``2026-02``."""
    return month_text(F.add_months(F.to_date(F.concat(_col(c), F.lit("-01"))), months))


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom as double; null where the bottom is zero or either side is null."""
    return _col(top).cast("double") / F.nullif(_col(bottom).cast("double"), F.lit(0.0))


def words_to(c: str | Column, words: dict, otherwise: str | None = None) -> Column:
    """Simple CASE: delivered word -> our word. Without ``otherwise`` an unknown word is null."""
    c, out = _col(c), None
    for said, meant in words.items():
        out = F.when(c == said, meant) if out is None else out.when(c == said, meant)
    return out if otherwise is None else out.otherwise(otherwise)


def per_system(system: str | Column, choices: dict[str, Column]) -> Column:
    """Pick one expression per source system; only the chosen branch is evaluated for a row."""
    system, out = _col(system), None
    for name, value in choices.items():
        out = F.when(system == name, value) if out is None else out.when(system == name, value)
    return out


def pseudonym(*parts: str | Column) -> Column:
    """md5 of the parts written together, the form existing keys have."""
    return F.md5(F.concat(*[_col(p) for p in parts]))


def salted_pseudonym(salt: str, *parts: str | Column) -> Column:
    """Stronger key for new installations: salted, and with the parts kept apart."""
    return F.sha2(F.concat_ws("|", F.lit(salt), *[_col(p) for p in parts]), 256)


def sum_if(cond: Column, value: str | Column) -> Column:
    """Conditional sum that is 0, not null, when rows exist but none matches."""
    return F.sum(F.when(cond, _col(value)).otherwise(F.lit(0)))


def count_where(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def rounded(df: DataFrame, scale: int = 2, only: dict[str, int] | None = None) -> DataFrame:
    """Round every decimal or floating column to ``scale`` places; ``only`` overrides per column."""
    only = only or {}
    fields = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            fields.append(F.round(F.col(f.name).cast("decimal(38,6)"), only.get(f.name, scale))
                          .cast("double").alias(f.name))
        else:
            fields.append(F.col(f.name))
    return df.select(*fields)


def doubles(df: DataFrame) -> DataFrame:
    """Decimals to doubles, for readers that want plain numbers at the edge."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
