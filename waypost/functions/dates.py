"""Mixed-layout date parsing and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waypost.functions.text import map_strict, strip
from waypost.sources.vocab import MONTHS_EN, MONTHS_IT

_CLOCK = r"(?:[ T]?(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?))?"
_YEAR = r"(\d{4})"
_DAY = r"(\d{1,2})"
_MONTH_ONLY, _DAY_ONLY = r"(0?[1-9]|1[0-2])", r"(1[3-9]|2\d|3[01])"
_SEP = r"[-/.]"

# Month names, full and short.
NAMES_EN = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
NAMES_IT = "gen(?:naio)?|feb(?:braio)?|mar(?:zo)?|apr(?:ile)?|mag(?:gio)?|giu(?:gno)?|lug(?:lio)?|ago(?:sto)?|set(?:tembre)?|ott(?:obre)?|nov(?:embre)?|dic(?:embre)?"


def layouts(day_first: bool, names: str) -> list[tuple[str, str]]:
    """Accepted layouts with their ISO forms; ``#`` stands for a named month.

    A numeric date is read in the other order of day and month only if the
    wanted one is impossible.
    """
    year_last, year_short = [], []
    for years, out in ((_YEAR, "$3"), (r"(\d{2})", "20$3")):
        other = (_MONTH_ONLY + _SEP + _DAY_ONLY, f"{out}-$1-$2") if day_first else (_DAY_ONLY + _SEP + _MONTH_ONLY, f"{out}-$2-$1")
        wanted = (_DAY + _SEP + _DAY, f"{out}-$2-$1" if day_first else f"{out}-$1-$2")
        for shape, iso in (other, wanted):
            (year_last if years == _YEAR else year_short).append((shape + _SEP + years, iso))
    return [
        (rf"^{_YEAR}[-/]{_DAY}[-/]{_DAY}{_CLOCK}$", "$1-$2-$3 $4"),
        *((f"^{shape}{_CLOCK}$", f"{iso} $4") for shape, iso in year_last),
        *((f"^{shape}$", iso) for shape, iso in year_short),
        (rf"^{_YEAR}(\d{{2}})(\d{{2}})$", "$1-$2-$3"),
        (rf"^(?i)(?:{names})\.? {_DAY},? {_YEAR}{_CLOCK}$", "$2-#-$1 $3"),
        (rf"^(?i){_DAY} (?:{names})\.?,? {_YEAR}{_CLOCK}$", "$2-#-$1 $3"),
    ]


def parse_dates(col: Column, day_first: bool = True, italian_months: bool = False) -> Column:
    """Timestamp (without zone) from any accepted layout, else NULL.

    The first layout that fits rewrites the text to ISO form, and the result is
    cast once. Rewriting instead of trying formats in turn avoids a thrown parse
    error per row and layout.
    """
    text = strip(col)
    names, months = (f"{NAMES_EN}|{NAMES_IT}", {**MONTHS_EN, **MONTHS_IT}) if italian_months else (NAMES_EN, MONTHS_EN)
    month = map_strict(F.upper(F.substring(F.regexp_extract(text, "([A-Za-z]{3})", 1), 1, 3)), months)
    iso = F.lit(None).cast("string")
    for shape, form in reversed(layouts(day_first, names)):
        rewritten = F.regexp_replace(text, shape, form)
        iso = F.when(text.rlike(shape), F.replace(rewritten, F.lit("#"), month) if "#" in form else rewritten).otherwise(iso)
    return F.trim(iso).try_cast("timestamp_ntz")


def calendar_columns(col: Column) -> dict[str, Column]:
    """Day, year, month, day of week (Monday = 0) and weekend flag."""
    day = F.to_date(col)
    return {
        "event_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day_of_week": F.weekday(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }
