"""Route-level aggregates and the route master table.

Both source tables are first reduced to one row per (route, category
combination). That aggregate is hash-based and combines map-side, so a route
holding a third of all rows reaches the exchange as a handful of rows, and
everything after it (pivots, modes, shares, top categories, perimeters) works
on the reduced tables only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waypost.functions.numbers import ratio
from waypost.operators.joins import outer_join_with_coverage
from waypost.session import materialize
from waypost.sources.files import numeric_columns, q

ROUTE = ["departure_airport_iata", "arrival_airport_iata"]
DESCRIPTORS = ["departure_city", "departure_country", "departure_country_code", "arrival_city"]


@dataclass(frozen=True)
class Categories:
    """Category values that become columns. Frozen lists keep columns stable."""

    occurrences: list[str] = field(default_factory=list)
    nationalities: list[str] = field(default_factory=list)
    documents: list[str] = field(default_factory=list)
    outcomes: list[str] = field(default_factory=list)


def route_label() -> Column:
    return F.concat_ws("→", *ROUTE)


def coded(df: DataFrame) -> DataFrame:
    """Rows that belong to a route: both airport codes are known.

    Two missing codes are not the same airport, so such rows leave before any
    route aggregate; ``uncoded`` counts them.
    """
    return df.dropna(subset=ROUTE)


def uncoded(df: DataFrame) -> DataFrame:
    """One row: rows in all, and rows that no route can hold because a code is missing."""
    missing = F.col(ROUTE[0]).isNull() | F.col(ROUTE[1]).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(missing).alias("n_uncoded"))


def reduce_alarms(alarms: DataFrame) -> DataFrame:
    """Alarm rows -> (route, descriptors, zone, occurrence, reason, risk)."""
    dims = [*ROUTE, *[c for c in DESCRIPTORS if c in alarms.columns], "zone", "occurrences", "alarm_reason", "risk_flag"]
    return coded(alarms).groupBy(*dims).agg(
        F.sum("total_flights").alias("flights"),
        F.count(F.lit(1)).alias("n"),
        F.min("departure_date").alias("first_date"),
    )


def reduce_travelers(travelers: DataFrame) -> DataFrame:
    """Traveller rows -> (route, nationality, document, outcome)."""
    dims = [c for c in ("nationality", "document_type2", "control_outcome") if c in travelers.columns]
    return coded(travelers).groupBy(*ROUTE, *dims).agg(
        F.sum("entries").alias("entries"),
        F.sum("investigated").alias("investigated"),
        F.sum("alarms").alias("alarms"),
        F.count(F.lit(1)).alias("n"),
    )


def pivot_occurrences(alarms: DataFrame, values: Sequence[str]) -> DataFrame:
    """Flights per (route, occurrence), missing combinations 0.

    Routes that only have unclassified occurrences do not appear. The column
    for the occurrence ``entries`` is ``tot_occ_entries`` because the traveller
    side already owns ``tot_entries``.
    """
    known = coded(alarms).filter(F.col("occurrences").isNotNull())
    table = known.groupBy(*ROUTE).pivot("occurrences", list(values)).agg(F.sum("total_flights"))
    return table.select(*ROUTE, *[F.coalesce(q_col(v), F.lit(0)).cast("bigint").alias(occurrence_column(v)) for v in values])


def q_col(name: str) -> Column:
    return F.col(q(name))


def occurrence_column(value: str) -> str:
    return "tot_occ_entries" if value == "entries" else f"tot_{value}"


def _descriptor(col: str) -> Column:
    """Non-null value of the earliest date; smallest value on ties."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.struct("first_date", col)))


def _descriptor_columns(reduced: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """Reduced rows with mode weights, and the aggregates that use them.

    Placing the reduced rows by route once serves both weights, the aggregate
    and the route join after it.
    """
    weighted = reduced.repartition(*keys).withColumns(
        {
            "_zone_n": F.sum("n").over(W.partitionBy(*keys, "zone")),
            "_reason_n": F.sum("n").over(W.partitionBy(*keys, "alarm_reason")),
        }
    )

    def mode(col: str, weight: str) -> Column:
        return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.struct(-F.col(weight), F.col(col))))

    aggs = [_descriptor(c).alias(c) for c in DESCRIPTORS if c in reduced.columns]
    aggs += [
        mode("zone", "_zone_n").alias("zone"),
        F.coalesce(F.sum(F.when(F.col("risk_flag") == "HIGH RISK", F.col("n"))), F.lit(0)).alias("n_high_risk"),
        F.coalesce(F.sum(F.when(F.col("risk_flag") == "MEDIUM RISK", F.col("n"))), F.lit(0)).alias("n_medium_risk"),
        mode("alarm_reason", "_reason_n").alias("alarm_reason_top"),
    ]
    return weighted, aggs


def route_descriptors(alarms: DataFrame) -> DataFrame:
    """First descriptors, most frequent zone and reason, risk counts per route."""
    weighted, aggs = _descriptor_columns(reduce_alarms(alarms), ROUTE)
    return weighted.groupBy(*ROUTE).agg(*aggs)


def alarm_routes(reduced: DataFrame, occurrences: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Occurrence pivot and descriptors together, from the reduced alarm table.

    Both share the route key, so one aggregate replaces the join of two. A
    route without any classified occurrence is dropped, as the join would do.
    """
    keys = [*by, *ROUTE]
    weighted, aggs = _descriptor_columns(reduced, keys)
    pivots = [
        F.coalesce(F.sum(F.when(F.col("occurrences") == v, F.col("flights"))), F.lit(0)).alias(occurrence_column(v))
        for v in occurrences
    ]
    table = weighted.groupBy(*keys).agg(F.count("occurrences").alias("_classified"), *pivots, *aggs)
    return table.filter(F.col("_classified") > 0).drop("_classified")


def join_route_parts(alarms: DataFrame, occurrences: Sequence[str]) -> DataFrame:
    return alarm_routes(reduce_alarms(alarms), occurrences)


def top_categories(df: DataFrame, col: str, k: int, exclude: Sequence[str] = (), weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent values with their rank; ties by value.

    Excluded values are removed after the top ``k`` is taken, so the result
    may hold fewer than ``k`` rows.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, F.col(col).alias("value")).agg(n.alias("n"))
    if by:
        place = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("n"), "value"))
        top = counts.withColumn("place", place).filter(F.col("place") <= k)
    else:
        first = counts.orderBy(F.desc("n"), "value").limit(k)
        top = first.withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), "value")))
    return top.filter(~F.col("value").isin(list(exclude))) if exclude else top


def _values(top: DataFrame) -> list[str]:
    return [r["value"] for r in top.orderBy("place").collect()]


def discover_categories(reduced_alarms: DataFrame, reduced_travelers: DataFrame, k_nat: int = 3, k_doc: int = 3, k_out: int = 4) -> Categories:
    """Read the category values off the reduced tables.

    At most ten traveller values and the occurrence vocabulary reach the
    driver; these are column names, not data.
    """
    have = reduced_travelers.columns

    def top(col: str, k: int, exclude: Sequence[str] = ()) -> list[str]:
        return _values(top_categories(reduced_travelers, col, k, exclude, "n")) if col in have else []

    seen = reduced_alarms.filter(F.col("occurrences").isNotNull()).select("occurrences").distinct()
    return Categories(
        occurrences=sorted(r[0] for r in seen.collect()),
        nationalities=top("nationality", k_nat, ["Unknown"]),
        documents=top("document_type2", k_doc),
        outcomes=top("control_outcome", k_out),
    )


def _totals() -> list[Column]:
    return [
        F.sum("entries").alias("tot_entries"),
        F.sum("investigated").alias("tot_investigated"),
        F.sum("alarms").alias("tot_alarms"),
        F.sum("n").alias("n_records"),
    ]


def _rates() -> dict[str, Column]:
    intensity = ratio(F.col("tot_alarms"), F.col("tot_investigated"))
    return {
        "alarm_intensity": intensity,
        "alert_rate": F.when(intensity.isNotNull(), F.least(intensity, F.lit(1.0))),
        "investigation_rate": ratio(F.col("tot_investigated"), F.col("tot_entries")),
    }


def _segment_rate(match: Column) -> Column:
    return ratio(F.sum(F.when(match, F.col("alarms"))), F.sum(F.when(match, F.col("investigated"))))


def _share(match: Column) -> Column:
    """Share of all rows of the group."""
    return F.coalesce(F.sum(F.when(match, F.col("n"))), F.lit(0)) / F.sum("n")


def _outcome_share(match: Column) -> Column:
    """Share of the rows with an outcome; 0 when there are none."""
    known = F.sum(F.when(F.col("control_outcome").isNotNull(), F.col("n")))
    return F.coalesce(F.sum(F.when(match, F.col("n"))) / known, F.lit(0.0))


def _unit(travelers: DataFrame) -> DataFrame:
    return coded(travelers).withColumn("n", F.lit(1).cast("bigint"))


def route_traveler_agg(travelers: DataFrame) -> DataFrame:
    """Totals, intensity, capped alert rate and investigation rate per route."""
    return _unit(travelers).groupBy(*ROUTE).agg(*_totals()).withColumns(_rates())


def segmented_rates(travelers: DataFrame, col: str, values: Sequence[str], prefix: str) -> DataFrame:
    """Alert rate per route within each given category value."""
    return coded(travelers).groupBy(*ROUTE).agg(*[_segment_rate(F.col(col) == v).alias(f"{prefix}{v}") for v in values])


def category_shares(travelers: DataFrame, nationalities: Sequence[str], outcomes: Sequence[str]) -> DataFrame:
    return (
        _unit(travelers)
        .groupBy(*ROUTE)
        .agg(
            *[_share(F.col("nationality") == v).alias(f"pct_nat_{v}") for v in nationalities],
            *[_outcome_share(F.col("control_outcome") == v).alias(f"pct_{v}") for v in outcomes],
        )
    )


def traveler_routes(reduced: DataFrame, cats: Categories) -> DataFrame:
    """All traveller aggregates of a route from the reduced table, one exchange."""
    aggs = _totals()
    for v in cats.nationalities:
        aggs += [_segment_rate(F.col("nationality") == v).alias(f"alert_rate_{v}"), _share(F.col("nationality") == v).alias(f"pct_nat_{v}")]
    aggs += [_segment_rate(F.col("document_type2") == v).alias(f"alert_rate_doc_{v}") for v in cats.documents]
    aggs += [_outcome_share(F.col("control_outcome") == v).alias(f"pct_{v}") for v in cats.outcomes]
    return _rates_first(reduced.groupBy(*ROUTE).agg(*aggs), ROUTE)


def _rates_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals, then route rates, then segment columns: the feature order."""
    totals = ["tot_entries", "tot_investigated", "tot_alarms", "n_records"]
    segments = [c for c in df.columns if c not in (*keys, *totals)]
    return df.withColumns(_rates()).select(*keys, *totals, *_rates(), *[q_col(c) for c in segments])


def fill_numeric0(df: DataFrame) -> DataFrame:
    """NULL -> 0 in every numeric column, as one-sided routes need it."""
    return df.na.fill(0, numeric_columns(df))


def combine_sides(alarm_side: DataFrame, traveler_side: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Full outer join of both route tables with coverage label and zero fill."""
    joined = outer_join_with_coverage(alarm_side, traveler_side, [*by, *ROUTE])
    return fill_numeric0(joined).withColumn("route", route_label())


def build_route_master(alarms: DataFrame, travelers: DataFrame, cats: Categories | None = None) -> DataFrame:
    """One row per route with every feature.

    Three exchanges carry data: one per reduced side and the route join. With
    frozen ``cats`` the plan stays lazy; otherwise the reduced tables are
    written once so that reading the category values costs no second scan.
    """
    a, t = reduce_alarms(alarms), reduce_travelers(travelers)
    if cats is None:
        a, t = materialize(a), materialize(t)
        cats = discover_categories(a, t)
    return combine_sides(alarm_routes(a, cats.occurrences), traveler_routes(t, cats))


def country_top_iata(travelers: DataFrame, country: str = "departure_country") -> DataFrame:
    """Most frequent departure airport per country (upper case), ties by code."""
    counts = (
        travelers.filter(F.col("departure_airport_iata").isNotNull())
        .groupBy(F.upper(country).alias("country"), "departure_airport_iata")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.struct(-F.col("n"), F.col("departure_airport_iata"))
    return counts.groupBy("country").agg(F.min_by("departure_airport_iata", best).alias("iata"))
