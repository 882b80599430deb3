"""Column -> Column text cleaning. Everything stays inside JVM code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\f\x0b"


def strip(col: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(col, F.lit(_BLANKS))


def null_placeholders(col: Column, tokens: Iterable[str]) -> Column:
    """Trimmed text, or NULL where it is one of ``tokens`` (any case)."""
    text = strip(col)
    return F.when(~F.lower(text).isin([t.lower() for t in tokens]), text)


def upper_trim(col: Column) -> Column:
    return F.upper(strip(col))


def title_text(col: Column, after_punctuation: bool = False) -> Column:
    """Title case with inner whitespace collapsed.

    ``after_punctuation`` also capitalises after an apostrophe, hyphen or any
    other non-letter (``O'Hare``), which ``initcap`` does not.
    """
    text = F.regexp_replace(strip(col), r"\s+", " ")
    if not after_punctuation:
        return F.initcap(text)
    pieces = F.split(F.lower(text), r"(?<=[^\p{L}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), ""
    )


def mapping(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def recode(col: Column, values: Mapping[str, str]) -> Column:
    """Replace known values and keep the others."""
    return F.coalesce(F.try_element_at(mapping(values), col), col)


def map_strict(col: Column, values: Mapping[str, str]) -> Column:
    """Replace known values; anything else becomes NULL."""
    return F.try_element_at(mapping(values), col)


def fill_placeholder(col: Column, value: str) -> Column:
    return F.coalesce(col, F.lit(value))


def fingerprint(col: Column, keep_digits: bool = False) -> Column:
    """Shape of a string.

    Digits become ``N`` and then every letter becomes ``A``. The letter pass
    also rewrites the fresh ``N``, so digits end up as ``A`` too; that is the
    default because published results look like this. ``keep_digits`` rewrites
    the letters first, which leaves ``N`` for digits.
    """
    if keep_digits:
        return F.regexp_replace(F.regexp_replace(col, "[a-zA-Z]", "A"), r"\d", "N")
    return F.regexp_replace(F.regexp_replace(col, r"\d", "N"), "[a-zA-Z]", "A")
