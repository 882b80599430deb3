"""Column -> Column number parsing and guarded arithmetic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from waypost.functions.text import strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_number(col: Column) -> Column:
    """Double, or NULL where the text is not a plain number."""
    text = strip(col)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_count(col: Column, unit: str = "pax") -> Column:
    """``"12 pax"`` -> 12.0; anything that is still not a number -> NULL."""
    bare = F.regexp_replace(col, f"(?i){unit}", "")
    return to_number(F.regexp_replace(bare, r"\s+", ""))


def parse_count_locale(col: Column, lo: float = 0, hi: float = 1000) -> Column:
    """Decimal comma, stray characters removed, NULL outside ``[lo, hi]``."""
    kept = F.regexp_replace(F.translate(col, ",", "."), r"[^\d.\-]", "")
    return null_out_of_range(to_number(kept), lo, hi)


def parse_bounded_count(col: Column, lo: int = 0, hi: int = 1000, suffix: str = "voli") -> Column:
    """``"~12 voli"`` -> 12; unparsable or out of range -> 0; half rounds to even."""
    bare = F.regexp_replace(strip(col), rf"\s*{suffix}\s*$", "")
    number = to_number(F.regexp_replace(bare, "^~+", ""))
    return F.rint(F.coalesce(null_out_of_range(number, lo, hi), F.lit(0.0))).cast("int")


def null_out_of_range(col: Column, lo: float, hi: float) -> Column:
    return F.when(col.between(lo, hi), col)


def clip(col: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to ``[lo, hi]``; NULL stays NULL."""
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(col.isNotNull(), out)


def clean_zone(col: Column, sentinels: Iterable[str], backup: Column | None = None) -> Column:
    """Zone as an integer in [0, 10], else the backup column."""
    text = strip(col.cast("string"))
    zone = null_out_of_range(to_number(F.when(~text.isin(list(sentinels)), text)), 0, 10).cast("int")
    if backup is None:
        return zone
    return F.coalesce(zone, to_number(backup.cast("string")).cast("int"))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL unless ``den > 0``."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def ratio_or(num: Column, den: Column, default: float) -> Column:
    return F.coalesce(ratio(num, den), F.lit(float(default)))


def finite_or_zero(col: Column) -> Column:
    """NULL, NaN and infinities -> 0."""
    bad = F.isnan(col) | (F.abs(col) == float("inf"))
    return F.when(col.isNull() | bad, 0.0).otherwise(col)
