"""Cleaning of the two raw tables, built from column expressions and dim joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.functions import numbers, text
from waypost.functions.dates import calendar_columns, parse_dates
from waypost.operators.joins import conflict
from waypost.operators.ordering import most_frequent
from waypost.operators.stats import quantiles, rows_from
from waypost.session import materialize
from waypost.sources import vocab
from waypost.sources.files import q, rename_columns, scan_csv, text_columns


def standardise_text(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Trim and upper-case the given (default: all) text columns."""
    chosen = list(cols) if cols is not None else text_columns(df)
    return df.withColumns({c: text.upper_trim(F.col(q(c))) for c in chosen})


def unify_unknown(df: DataFrame, cols: Sequence[str], variants: Sequence[str] = tuple(vocab.UNKNOWN_VARIANTS), to: str = "N.D.") -> DataFrame:
    return df.withColumns({c: F.when(F.col(q(c)).isin(list(variants)), to).otherwise(F.col(q(c))) for c in cols})


def junk_to_null(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = tuple(vocab.JUNK_TOKENS)) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(q(c)).isin(list(tokens)), F.col(q(c))) for c in cols})


def with_constants(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def coalesce_columns(df: DataFrame, out: str, cols: Sequence[str]) -> DataFrame:
    return df.withColumn(out, F.coalesce(*[F.col(q(c)) for c in cols]))


def add_calendar(df: DataFrame, col: str) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(col)))


def enrich_from_dim(
    df: DataFrame, key: str, dim: DataFrame, dim_key: str, columns: Mapping[str, str], mode: str = "overwrite"
) -> DataFrame:
    """Look columns up in a dimension table.

    ``columns`` maps target column -> dim column. ``overwrite`` replaces the
    target (NULL when the key is unknown); ``fill`` only fills missing values.
    """
    renamed = dim.select(F.col(dim_key).alias("_key"), *[F.col(src).alias(f"_dim_{i}") for i, src in enumerate(columns.values())])
    joined = df.join(renamed, F.col(q(key)) == F.col("_key"), "left")
    found: dict[str, Column] = {}
    for i, target in enumerate(columns):
        value = F.col(f"_dim_{i}")
        found[target] = F.coalesce(F.col(q(target)), value) if mode == "fill" and target in df.columns else value
    return joined.withColumns(found).drop("_key", *[f"_dim_{i}" for i in range(len(columns))])


def country_iso3(df: DataFrame, col: str, to_english: DataFrame, to_iso3: DataFrame, out: str, override: Mapping[str, str] | None = None) -> DataFrame:
    """Country name -> English name -> ISO-3, with explicit overrides first.

    ``to_english(country, english)`` and ``to_iso3(english, iso3)`` are tables.
    """
    two_step = to_english.join(to_iso3, "english").select("country", "iso3")
    named = df.withColumn("_country", text.strip(F.col(q(col))))
    looked_up = enrich_from_dim(named, "_country", two_step, "country", {out: "iso3"})
    forced = text.map_strict(F.col("_country"), override or {"Cossovo": "RKS"})
    return looked_up.withColumn(out, F.coalesce(forced, F.col(out))).drop("_country")


def resolve_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], prefer: str = "keep") -> tuple[DataFrame, DataFrame]:
    """Merge duplicate columns ``(keep, other)`` and report what happened.

    ``prefer="keep"`` fills gaps of the kept column only; ``prefer="other"``
    lets the other column win wherever it has a value. The statistics are one
    aggregate pass over the input.
    """
    used = [(k, o) for k, o in pairs if k in df.columns and o in df.columns]
    merged: dict[str, Column] = {}
    aggs: list[Column] = []
    records: list[dict[str, Column]] = []
    for i, (keep, other) in enumerate(used):
        a, b = F.col(q(keep)), F.col(q(other))
        clash = conflict(a, b)
        merged[keep] = F.coalesce(a, b) if prefer == "keep" else F.coalesce(b, a)
        aggs += [
            F.count_if(clash).alias(f"_c{i}"),
            F.count_if(a.isNull() & b.isNotNull()).alias(f"_f{i}"),
            F.count_if(b.isNotNull() & (a.isNull() | clash)).alias(f"_o{i}"),
        ]
        records.append(
            {
                "kept": F.lit(keep),
                "dropped": F.lit(other),
                "n_conflicts": F.col(f"_c{i}"),
                "n_filled": F.col(f"_f{i}"),
                "n_overwritten": F.col(f"_o{i}") if prefer == "other" else F.lit(0).cast("bigint"),
            }
        )
    stats = rows_from(df.agg(*aggs), records)
    return df.withColumns(merged).drop(*[o for _, o in used]), stats


def most_complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The candidate column with the most non-null values (first one on ties)."""
    counted = df.agg(*[F.count(F.col(q(c))).alias(f"_n{i}") for i, c in enumerate(cols)])
    table = rows_from(
        counted, [{"column_name": F.lit(c), "n_present": F.col(f"_n{i}"), "_i": F.lit(i)} for i, c in enumerate(cols)]
    )
    return table.orderBy(F.desc("n_present"), "_i").limit(1).drop("_i")


def filter_signal_range(df: DataFrame, cols: Sequence[str], cap: float = vocab.SIGNAL_CAP) -> DataFrame:
    """Keep rows whose every signal column lies in ``[0, cap]``."""
    for c in cols:
        df = df.filter(F.col(q(c)).between(0, cap))
    return df


def drop_unparsed(df: DataFrame, col: str) -> DataFrame:
    return df.na.drop(subset=[col])


def unparsed_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_if(F.col(col).isNull()).alias("n_unparsed"), F.count(F.lit(1)).alias("n_rows"))


def fingerprint_counts(df: DataFrame, col: str, keep_digits: bool = False) -> DataFrame:
    shape = text.fingerprint(F.col(q(col)), keep_digits)
    return df.filter(F.col(q(col)).isNotNull()).groupBy(shape.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def impute(df: DataFrame, spec: Mapping[str, str], constant: str = "UNKNOWN") -> DataFrame:
    """Fill NULLs: ``spec`` maps column -> ``median``, ``mode`` or ``constant``.

    All medians and modes come from one written table of (column, value) counts;
    one row per column reaches the driver. Ties of a mode take the smallest value.
    """
    kinds = dict(df.dtypes)
    counted = [c for c, how in spec.items() if how != "constant"]
    fills = {c: F.lit(constant) for c, how in spec.items() if how == "constant"}
    if counted:
        cells = [F.struct(F.lit(i).alias("i"), F.col(q(c)).try_cast("double").alias("number"), F.col(q(c)).cast("string").alias("text")) for i, c in enumerate(counted)]
        values = df.select(F.inline(F.array(*cells))).filter(F.col("text").isNotNull()).groupBy("i", "number", "text").agg(F.count(F.lit(1)).alias("w"))
        values = materialize(values)
        modes = values.groupBy("i").agg(F.min_by("text", F.struct(-F.col("w"), "number", "text")).alias("mode"))
        found = modes.join(quantiles(values, ["number"], [0.5], ["i"], "w", written=True), "i").select("i", "mode", F.col("number")[0].alias("median"))
        for r in found.collect():
            c = counted[r["i"]]
            fills[c] = F.lit(r["median"]) if spec[c] == "median" else F.lit(r["mode"]).cast(kinds[c])
    return df.withColumns({c: F.coalesce(F.col(q(c)), fill) for c, fill in fills.items()})


def missing_policy(df: DataFrame, hi: float = 0.6, lo: float = 0.2, exempt: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Drop, flag-and-fill or fill each column by its missing rate.

    Above ``hi`` the column is dropped; between ``lo`` and ``hi`` it is filled
    and gets a ``<column>_missing`` flag; below ``lo`` it is filled.
    """
    cols = [c for c in df.columns if c not in exempt]
    kinds = dict(df.dtypes)
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(q(c)).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)]
    )
    found = counted.first()
    total = max(found["_n"], 1)
    decisions, spec, drop, flag = [], {}, [], []
    for i, c in enumerate(cols):
        rate = found[f"_m{i}"] / total
        fill = "median" if kinds[c] not in ("string", "date", "boolean") and not kinds[c].startswith("timestamp") else "mode"
        if rate > hi:
            action = "drop"
            drop.append(c)
        elif rate >= lo:
            action = "fill_and_flag"
            flag.append(c)
            spec[c] = "median" if fill == "median" else "constant"
        elif rate > 0:
            action = f"fill_{fill}"
            spec[c] = fill
        else:
            action = "keep"
        decisions.append((c, float(rate), action))
    out = df.withColumns({f"{c}_missing": F.col(q(c)).isNull().cast("int") for c in flag}).drop(*drop)
    table = df.sparkSession.createDataFrame(decisions, "column_name string, missing_rate double, action string")
    return impute(out, spec), table


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violation count per rule; a rule is the condition valid rows meet."""
    names = list(rules)
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(~rules[r]).alias(f"_v{i}") for i, r in enumerate(names)])
    return rows_from(
        counted,
        [{"rule": F.lit(r), "n_violations": F.col(f"_v{i}"), "n_rows": F.col("_n")} for i, r in enumerate(names)],
    )


def iata_rule(col: str, pattern: str = "^[A-Z]{3}$") -> Column:
    return F.col(col).rlike(pattern)


def not_future_rule(col: str, today: Column | None = None) -> Column:
    return F.to_date(col) <= (today if today is not None else F.current_date())


def non_negative_rule(col: str) -> Column:
    return F.col(col) >= 0


def percentage_rule(col: str) -> Column:
    return F.col(col).between(0, 100)


def business_rules(iata: Sequence[str] = (), dates: Sequence[str] = (), counts: Sequence[str] = (), rates: Sequence[str] = ()) -> dict[str, Column]:
    rules = {f"iata:{c}": iata_rule(c) for c in iata}
    rules |= {f"not_future:{c}": not_future_rule(c) for c in dates}
    rules |= {f"non_negative:{c}": non_negative_rule(c) for c in counts}
    rules |= {f"percentage:{c}": percentage_rule(c) for c in rates}
    return rules


@dataclass(frozen=True)
class Dims:
    """Dimension tables of the cleaning chain."""

    airports: DataFrame  # iata, city, airport
    countries: DataFrame  # country, iso3


def _with_airport(df: DataFrame, side: str, dims: Dims) -> DataFrame:
    code = f"{side}_AIRPORT_IATA"
    upper = text.null_placeholders(text.upper_trim(F.col(code)), ["nan"])
    return enrich_from_dim(
        df.withColumn(code, upper),
        code,
        dims.airports,
        "iata",
        {f"{side}_CITY": "city", f"{side}_AIRPORT_DESCRIPTION": "airport"},
    )


def _with_country_code(df: DataFrame, dims: Dims) -> DataFrame:
    return enrich_from_dim(df, "DEPARTURE_COUNTRY", dims.countries, "country", {"DEPARTURE_COUNTRY_CODE": "iso3"})


def clean_travelers(df: DataFrame, dims: Dims) -> DataFrame:
    """Traveller table: codes, places, zone, recodes, signal columns and cap."""
    for side in ("DEPARTURE", "ARRIVAL"):
        if f"{side}_AIRPORT_IATA" in df.columns:
            df = _with_airport(df, side, dims)
    df = with_constants(df, {"ARRIVAL_COUNTRY": "ITALY", "ARRIVAL_COUNTRY_CODE": "ITA"})
    if "DEPARTURE_COUNTRY" in df.columns:
        df = _with_country_code(df.withColumn("DEPARTURE_COUNTRY", text.strip(F.col("DEPARTURE_COUNTRY"))), dims)

    have = set(df.columns)
    new: dict[str, Column] = {}
    if "ZONE" in have:
        new["ZONE"] = numbers.clean_zone(F.col("ZONE"), vocab.ZONE_SENTINELS)
    if "GENDER" in have:
        new["GENDER"] = text.fill_placeholder(text.recode(F.upper("GENDER"), vocab.GENDER), "N.D.")
    if "OPERATOR_NOTES" in have:
        new["OPERATOR_NOTES"] = text.fill_placeholder(text.upper_trim(F.col("OPERATOR_NOTES")), vocab.NO_NOTES)
    if "TRANSIT_FLAG" in have:
        flag = text.recode(F.upper("TRANSIT_FLAG"), vocab.TRANSIT)
        new["TRANSIT_FLAG"] = F.when(flag != "N/C", flag)
    if "NATIONALITY" in have:
        known = F.when(~F.col("NATIONALITY").isin(vocab.NATIONALITY_PLACEHOLDERS), F.col("NATIONALITY"))
        new["NATIONALITY"] = text.fill_placeholder(known, "Unknown")
    signals = [c for c in ("ENTRIES", "INVESTIGATED", "ALARMS") if c in have]
    new |= {c: numbers.parse_count(F.col(c).cast("string")) for c in signals}
    df = df.withColumns(new).drop(
        "ZONE_3", "NATIONALITY_3", "DEPARTURE_YEAR", "DEPARTURE_MONTH",
        "AGE_GROUP", "DOCUMENT_TYPE", "AIRLINE", "FLIGHT_NUMBER",
    )
    if len(signals) == 3:
        df = filter_signal_range(df, signals).withColumns({c: F.col(c).cast("int") for c in signals})
    return df


def clean_alarms(df: DataFrame, dims: Dims) -> DataFrame:
    """Alarm table: vocabulary, zone, texts, risk flag, places and flight count."""
    df = df.drop("DEPARTURE_MONTH", "DEPARTURE_YEAR", "ARRIVAL_COUNTRY_CODE", "ARRIVAL_COUNTRY_CODE_PERCENTAGE")
    have = set(df.columns)
    new: dict[str, Column] = {}
    if "OCCURRENCES" in have:
        new["OCCURRENCES"] = text.map_strict(F.lower(text.strip(F.col("OCCURRENCES"))), vocab.OCCURRENCES)
    if "ZONE" in have:
        backup = F.col("ZONE_3") if "ZONE_3" in have else None
        new["ZONE"] = numbers.clean_zone(F.col("ZONE"), vocab.ZONE_SENTINELS, backup)
    for c, placeholder in (("ALARM_REASON", vocab.NO_REASON), ("OPERATOR_NOTES", vocab.NO_MANUAL_NOTES)):
        if c in have:
            new[c] = text.fill_placeholder(text.upper_trim(F.col(c)), placeholder)
    if "RISK_FLAG" in have:
        new["RISK_FLAG"] = text.fill_placeholder(text.recode(F.col("RISK_FLAG"), vocab.RISK), vocab.RISK_DEFAULT)
    countries = [F.col(c) for c in ("DEPARTURE_COUNTRY_FULL", "DEPARTURE_COUNTRY") if c in have]
    if countries:
        new["DEPARTURE_COUNTRY"] = F.coalesce(*[text.null_placeholders(c, vocab.PLACEHOLDERS) for c in countries])
    if "TOTAL_FLIGHTS" in have:
        new["TOTAL_FLIGHTS"] = numbers.parse_bounded_count(F.col("TOTAL_FLIGHTS").cast("string"), 0, vocab.FLIGHT_CAP)
    df = df.withColumns(new)
    for side in ("DEPARTURE", "ARRIVAL"):
        df = _with_airport(df, side, dims)
    if countries:
        df = _with_country_code(df, dims)
    df = with_constants(df, {"ARRIVAL_COUNTRY": "Italia", "ARRIVAL_COUNTRY_CODE": "ITA"})
    return df.drop("ZONE_3", "DEPARTURE_COUNTRY_FULL", "TOTAL")


def _loaded(spark: SparkSession, folder: str, dims: Dims, italian_months: bool) -> tuple[DataFrame, DataFrame]:
    """Both tables cleaned, dates parsed, undated rows still there."""

    def raw(name: str) -> DataFrame:
        return rename_columns(scan_csv(spark, f"{folder}/{name}.csv"), vocab.COLUMN_NAMES)

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("DEPARTURE_DATE", parse_dates(F.col("DEPARTURE_DATE"), italian_months=italian_months))

    return dated(clean_alarms(raw("ALLARMI"), dims)), dated(clean_travelers(raw("TIPOLOGIA_VIAGGIATORE"), dims))


def load_clean_data(spark: SparkSession, folder: str, dims: Dims, italian_months: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read both CSV files, rename, clean, parse dates, drop undated rows (``undated_rows`` counts them)."""
    alarms, travelers = _loaded(spark, folder, dims, italian_months)
    return drop_unparsed(alarms, "DEPARTURE_DATE"), drop_unparsed(travelers, "DEPARTURE_DATE")


def undated_rows(spark: SparkSession, folder: str, dims: Dims, italian_months: bool = False) -> DataFrame:
    """One row per table: its rows, and those that loading drops because their date is in no accepted layout."""
    alarms, travelers = _loaded(spark, folder, dims, italian_months)
    counts = [unparsed_count(df, "DEPARTURE_DATE").withColumn("source", F.lit(name)) for name, df in (("alarms", alarms), ("travelers", travelers))]
    return counts[0].unionByName(counts[1])
