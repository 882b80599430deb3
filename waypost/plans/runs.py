"""The three ways to run the analysis, as plain function composition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from waypost.operators.detectors import fit_detectors, fit_panel_detectors
from waypost.operators.panel import engineer_features
from waypost.operators.perimeters import (
    IATA_TOKEN,
    RequestDims,
    apply_perimeter,
    country_airports,
    perimeter_row_counts,
    perimeter_status,
    resolve_requests,
    tag_perimeters,
    traveler_routes_by_perimeter,
)
from waypost.operators.ranking import apply_business_rules, apply_post_processing, drop_disqualified
from waypost.operators.reports import audit_observed, perimeter_json, render_report, report_payload
from waypost.operators.routes import (
    Categories,
    alarm_routes,
    build_route_master,
    combine_sides,
    discover_categories,
    reduce_alarms,
    reduce_travelers,
)
from waypost.session import materialize
from waypost.sources import vocab

SCOPE = "perimeter_id"


@dataclass(frozen=True)
class RouteRun:
    """Frames of one run; all are lazy scans of written tables."""

    routes: DataFrame
    scored: DataFrame
    post: DataFrame
    clean: DataFrame
    audit: DataFrame  # one row per stage, counted while it was written


def run_routes(alarms: DataFrame, travelers: DataFrame, cats: Categories | None = None, contamination: float = vocab.CONTAMINATION, seed: int = vocab.SEED) -> RouteRun:
    """Whole data: route master, detectors, ranking."""
    seen = {stage: Observation() for stage in ("routes", "detectors", "ranking")}
    routes = materialize(build_route_master(alarms, travelers, cats), seen["routes"])
    scored = materialize(fit_detectors(routes, contamination=contamination, seed=seed, dbscan_info=True), seen["detectors"], consensus=F.sum("anomaly_consensus"))
    post = materialize(apply_post_processing(scored)[0], seen["ranking"], disqualified=F.count_if(F.col("quality_note").isin(vocab.DISQUALIFYING)))
    return RouteRun(routes, scored, post, drop_disqualified(post), audit_observed(routes.sparkSession, seen))


@dataclass(frozen=True)
class PerimeterRun:
    requests: DataFrame  # one row per request: perimeter, status, reason
    scored: DataFrame  # keyed by perimeter and route
    post: DataFrame
    clean: DataFrame
    reports: DataFrame  # one row per request: report_md


def run_perimeters(
    requests: DataFrame, alarms: DataFrame, travelers: DataFrame, dims: RequestDims, country: str = "departure_country",
    token: str = IATA_TOKEN, occurrences: Sequence[str] | None = None, contamination: float = vocab.CONTAMINATION, seed: int = vocab.SEED,
) -> PerimeterRun:
    """Every requested perimeter in one job.

    Both tables are reduced once; perimeters are cut from the reduced tables
    and every later aggregate, scale, detector and threshold is grouped by
    perimeter. Requests that name the same perimeter share its computation.
    """
    named = travelers if country in travelers.columns else alarms
    resolved = resolve_requests(requests, dims, country_airports(named, country), token)
    a, t = materialize(reduce_alarms(alarms)), materialize(reduce_travelers(travelers))
    asked = materialize(perimeter_status(resolved, perimeter_row_counts(a, t, weight="n")))
    ready = asked.filter(F.col("status") == "ready").select(SCOPE)
    if occurrences is None:
        occurrences = discover_categories(a, t).occurrences
    tagged_a, tagged_t = tag_perimeters(a, ready), materialize(tag_perimeters(t, ready))
    routes = combine_sides(alarm_routes(tagged_a, occurrences, [SCOPE]), traveler_routes_by_perimeter(tagged_t), [SCOPE])
    routes = materialize(routes)
    scored = materialize(fit_detectors(routes, contamination=contamination, seed=seed, by=[SCOPE]))
    post = materialize(apply_post_processing(scored, [SCOPE])[0])
    clean = drop_disqualified(post)
    payload = report_payload(scored, clean, [SCOPE])
    bodies = render_report(asked.join(payload, SCOPE, "left"), perimeter_json(F.col("role"), F.col("iata")))
    return PerimeterRun(asked, scored, post, clean, bodies.select("request_id", SCOPE, "status", "reason", "report_md"))


def run_panel(
    travelers: DataFrame, alarms: DataFrame, values: Mapping[str, Sequence[str]], order: Sequence[str], perimeter: Mapping | None = None,
    contamination: float = vocab.PANEL_CONTAMINATION, seed: int = vocab.SEED,
) -> DataFrame:
    """Event level: panel, detectors, rules. A perimeter filters first, so its
    baselines are its own. The row key is the panel's grain as text."""
    if perimeter:
        travelers = apply_perimeter(travelers, perimeter, "travelers")
        alarms = apply_perimeter(alarms, perimeter, "alarms")
    panel = engineer_features(travelers, alarms, values, order)
    keyed = panel.withColumn("row_key", F.concat_ws("|", "departure_airport_iata", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]))
    return apply_business_rules(materialize(fit_panel_detectors(materialize(keyed), "row_key", contamination, seed)))
