"""Perimeters: filters, free-text requests, and many perimeters in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.functions.numbers import to_number
from waypost.functions.text import upper_trim
from waypost.operators.routes import ROUTE, _outcome_share, _rates_first, _segment_rate, _share, _totals, country_top_iata, top_categories
from waypost.sources import vocab

# Perimeter key -> (traveller column, alarm column).
PERIMETER_COLUMNS = {
    "airport_iata": ("departure_airport_iata", "departure_airport_iata"),
    "departure_country": ("departure_country_code", "departure_country_code"),
    "month": ("departure_month", "departure_month"),
    "year": ("departure_year", "departure_year"),
    "nationality": ("nationality", None),
    "document_type": ("document_type", None),
    "age_band": ("age_band", None),
}

SIDES = ("travelers", "alarms")
IATA_TOKEN = "[A-Z]{3}"
GLOBAL = "global"
NO_MATCH = "No IATA, city or country recognised in the request."


def perimeter_condition(columns: Sequence[str], perimeter: Mapping, side: str, names: Mapping = PERIMETER_COLUMNS) -> tuple[Column, list[str]]:
    """AND of the usable filters, and the keys that had to be ignored."""
    which = SIDES.index(side)
    condition, ignored = F.lit(True), []
    for key, wanted in perimeter.items():
        target = names.get(key, (None, None))[which]
        if target is None or target not in columns:
            ignored.append(key)
            continue
        values = list(wanted) if isinstance(wanted, (list, tuple, set, frozenset)) else [wanted]
        if values and isinstance(values[0], (int, float)) and not isinstance(values[0], bool):
            match = to_number(F.col(target).cast("string")).isin([float(v) for v in values])
        else:
            match = upper_trim(F.col(target).cast("string")).isin([str(v).strip().upper() for v in values])
        condition = condition & match
    return condition, ignored


def apply_perimeter(df: DataFrame, perimeter: Mapping, side: str = "travelers", names: Mapping = PERIMETER_COLUMNS) -> DataFrame:
    """Rows inside the perimeter; text is matched without case, numbers by value.

    Unknown keys, and keys this side has no column for, are ignored.
    """
    condition, _ = perimeter_condition(df.columns, perimeter, side, names)
    return df.filter(condition)


def ignored_keys(spark, columns: Sequence[str], perimeter: Mapping, side: str, names: Mapping = PERIMETER_COLUMNS) -> DataFrame:
    """Audit rows for the perimeter keys that had no effect on this side."""
    _, ignored = perimeter_condition(columns, perimeter, side, names)
    return spark.createDataFrame([(side, k) for k in ignored], "side string, ignored_key string")


def request_role(col: Column, words: Sequence[str] = tuple(vocab.ARRIVAL_WORDS)) -> Column:
    return F.when(col.rlike(rf"(?i)\b({'|'.join(words)})\b"), "arrival").otherwise("departure")


def _words(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(r"(?U)(\w+)"), F.lit(1))


def _phrases(words: Column, longest: int) -> Column:
    """Every run of 1..longest consecutive words."""

    def runs(n: int) -> Column:
        last = F.size(words) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, n), " "))

    return F.array_distinct(F.flatten(F.array(*[runs(n) for n in range(1, longest + 1)])))


def _name_matches(requests: DataFrame, names: DataFrame) -> DataFrame:
    """Requests that mention a name as whole words.

    ``names`` has ``name`` (upper case), ``iata`` and ``ord``. The word runs of
    the request meet the names by equality; the exact pattern then confirms
    the few candidates, so requests and names are never paired freely.
    """
    keyed = names.withColumn("_phrase", F.array_join(_words(F.col("name")), " "))
    longest = keyed.agg(F.max(F.size(_words(F.col("name"))))).first()[0] or 1
    spoken = requests.select("request_id", "_text", F.explode(_phrases(_words(F.col("_text")), longest)).alias("_phrase"))
    pattern = F.concat(F.lit(r"(?U)\b\Q"), F.col("name"), F.lit(r"\E\b"))
    return spoken.join(keyed, "_phrase").filter(F.rlike("_text", pattern)).select("request_id", "iata", (-F.length("name")).alias("_a"), F.col("ord").cast("int").alias("_b"))


@dataclass(frozen=True)
class RequestDims:
    airports: DataFrame  # iata
    cities: DataFrame  # city (upper case), iata, ord
    countries: DataFrame  # country, ord


def resolve_requests(
    requests: DataFrame, dims: RequestDims, country_airports: DataFrame, token: str = IATA_TOKEN,
    stop_words: Sequence[str] = tuple(vocab.REQUEST_STOP_WORDS),
) -> DataFrame:
    """Free text -> perimeter, one row per request.

    First an airport code in the order of the text, then the longest city
    name, then the longest country name that has traffic. ``country_airports``
    has ``country`` (upper case) and ``iata``. An empty request means the whole
    data; a request without a match is invalid.
    """
    asked = requests.withColumn("_text", F.upper(F.coalesce("user_request", F.lit(""))))
    tokens = F.regexp_extract_all(F.col("_text"), F.lit(rf"\b({token})\b"), F.lit(1))
    codes = (
        asked.select("request_id", F.posexplode(tokens).alias("_a", "iata"))
        .filter(~F.col("iata").isin(list(stop_words)))
        .join(dims.airports.select("iata").distinct(), "iata")
        .select("request_id", "iata", F.lit(1).alias("_stage"), F.col("_a").cast("int").alias("_a"), F.lit(0).alias("_b"))
    )
    city_names = dims.cities.select(F.col("city").alias("name"), "iata", "ord")
    cities = _name_matches(asked, city_names).withColumn("_stage", F.lit(2))
    named = dims.countries.select(F.upper("country").alias("country"), "ord").join(country_airports, "country")
    countries = _name_matches(asked, named.select(F.col("country").alias("name"), "iata", "ord")).withColumn("_stage", F.lit(3))
    best = F.struct("_stage", "_a", "_b", "iata")
    found = (
        codes.unionByName(cities).unionByName(countries).groupBy("request_id").agg(F.min(best).alias("_best"))
        .select("request_id", F.col("_best.iata").alias("iata"), F.col("_best._stage").alias("_stage"))
    )
    empty = F.trim(F.coalesce("user_request", F.lit(""))) == ""
    role = F.when(F.col("iata").isNotNull(), request_role(F.col("user_request")))
    how = F.element_at(F.array(F.lit("code"), F.lit("city"), F.lit("country")), F.col("_stage"))
    return (
        requests.join(found, "request_id", "left")
        .withColumn("iata", F.when(~empty, F.col("iata")))
        .withColumns({"role": role, "matched_by": F.when(empty, GLOBAL).when(F.col("iata").isNotNull(), how)})
        .withColumn(
            "perimeter_id",
            F.when(empty, GLOBAL).when(F.col("iata").isNotNull(), F.concat_ws(":", "role", "iata")),
        )
        .drop("_stage")
    )


def perimeter_row_counts(alarms: DataFrame, travelers: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows of both tables per possible perimeter. ``weight`` counts reduced rows."""
    n = F.col(weight) if weight else F.lit(1)

    def side(df: DataFrame, name: str) -> DataFrame:
        pairs = df.groupBy(*ROUTE).agg(F.sum(n).alias("n"))
        return _tagged(pairs).groupBy("perimeter_id").agg(F.sum("n").alias(name))

    return side(alarms, "n_alarms").join(side(travelers, "n_travelers"), "perimeter_id", "full").na.fill(0, ["n_alarms", "n_travelers"])


def perimeter_status(resolved: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds ``status`` (ready, empty_perimeter, invalid_input), ``reason`` and row counts."""
    joined = resolved.join(counts, "perimeter_id", "left").na.fill(0, ["n_alarms", "n_travelers"])
    none = (F.col("n_alarms") == 0) & (F.col("n_travelers") == 0) & (F.col("perimeter_id") != GLOBAL)
    status = F.when(F.col("perimeter_id").isNull(), "invalid_input").when(none, "empty_perimeter").otherwise("ready")
    reason = F.when(F.col("perimeter_id").isNull(), NO_MATCH).when(
        none, F.concat(F.lit("No records found for "), F.col("role"), F.lit(" IATA = "), F.col("iata"), F.lit("."))
    )
    return joined.withColumns({"status": status, "reason": reason})


def _tagged(df: DataFrame) -> DataFrame:
    """Each row once per perimeter it can belong to: departure, arrival, all."""
    dep, arr = ROUTE
    ids = F.array(F.concat_ws(":", F.lit("departure"), dep), F.concat_ws(":", F.lit("arrival"), arr), F.lit(GLOBAL))
    return df.withColumn("perimeter_id", F.explode(ids))


def tag_perimeters(reduced: DataFrame, perimeters: DataFrame) -> DataFrame:
    """Reduced rows of the wanted perimeters, with ``perimeter_id``.

    Perimeters only select whole routes, so they can be cut from the reduced
    tables: the raw data is aggregated once however many requests there are.
    The list of perimeters holds at most two entries per airport code.
    """
    wanted = perimeters.select("perimeter_id").distinct()
    # Two entries per airport code and the whole: thousands, whatever the data. Dealt by perimeter, the whole would be one task.
    return _tagged(reduced).join(F.broadcast(wanted), "perimeter_id", "left_semi")


def traveler_routes_by_perimeter(tagged: DataFrame, k_nat: int = 3, k_doc: int = 3, k_out: int = 4) -> DataFrame:
    """Traveller aggregates per (perimeter, route).

    Each perimeter has its own top categories, so the columns are numbered
    slots (``alert_rate_nat_1``); ``category_slots`` tells what they stand for.
    """
    by = ["perimeter_id"]
    wide = tagged
    for col, slot, k, exclude in _slots(k_nat, k_doc, k_out):
        top = top_categories(tagged, col, k, exclude, "n", by).select(*by, F.col("value").alias(col), F.col("place").alias(slot))
        # At most ``k`` rows per perimeter, of which there are two per airport code and the whole.
        wide = wide.join(F.broadcast(top), [*by, col], "left")
    aggs = _totals()
    for i in range(1, k_nat + 1):
        hit = F.col("_nat") == i
        aggs += [_segment_rate(hit).alias(f"alert_rate_nat_{i}"), _share(hit).alias(f"pct_nat_{i}")]
    aggs += [_segment_rate(F.col("_doc") == i).alias(f"alert_rate_doc_{i}") for i in range(1, k_doc + 1)]
    aggs += [_outcome_share(F.col("_out") == i).alias(f"pct_outcome_{i}") for i in range(1, k_out + 1)]
    return _rates_first(wide.groupBy(*by, *ROUTE).agg(*aggs), [*by, *ROUTE])


def _slots(k_nat: int, k_doc: int, k_out: int):
    return [
        ("nationality", "_nat", k_nat, ["Unknown"]),
        ("document_type2", "_doc", k_doc, []),
        ("control_outcome", "_out", k_out, []),
    ]


def category_slots(tagged: DataFrame, k_nat: int = 3, k_doc: int = 3, k_out: int = 4) -> DataFrame:
    """(perimeter, kind, slot, value): what the numbered columns stand for."""
    out = None
    for col, _, k, exclude in _slots(k_nat, k_doc, k_out):
        top = top_categories(tagged, col, k, exclude, "n", ["perimeter_id"])
        part = top.select("perimeter_id", F.lit(col).alias("kind"), F.col("place").cast("bigint").alias("slot"), "value", "n")
        out = part if out is None else out.unionByName(part)
    return out


def country_airports(travelers: DataFrame, country: str = "departure_country") -> DataFrame:
    return country_top_iata(travelers, country)
