"""Thresholds, levels, intervals, priority and rank, given the votes."""

from __future__ import annotations

from pyspark.sql import functions as F

from waypost.operators import ranking as G
from waypost.operators.ordering import global_rank
from waypost.plans.detector_queries import FLAGGED, voted_routes
from waypost.plans.fixtures import CATEGORIES, view
from waypost.plans.registry import R, n64, query, r6
from waypost.plans.route_queries import KEYS, routes_of
from waypost.plans.runs import run_routes
from waypost.session import materialize
from waypost.sources import vocab

_N = "CAST(tot_investigated AS DOUBLE)"
_K = f"round_even(alert_rate * {_N}, 0)"
_CENTRE = f"({_K} + 1.96 * 1.96 / 2) / ({_N} + 1.96 * 1.96)"
_MARGIN = f"1.96 * sqrt({_K} * ({_N} - {_K}) / {_N} + 1.96 * 1.96 / 4) / ({_N} + 1.96 * 1.96)"
LOW = f"CASE WHEN tot_investigated > 0 THEN greatest(0.0, {_CENTRE} - {_MARGIN}) END"
HIGH = f"CASE WHEN tot_investigated > 0 THEN least(1.0, {_CENTRE} + {_MARGIN}) END"
NOTE = f"""CASE WHEN tot_investigated = 0 AND alert_rate > 0 THEN '{vocab.NOTE_INCOMPLETE}'
WHEN alert_rate = 0 AND tot_investigated <= 2 THEN '{vocab.NOTE_FALSE_POSITIVE}'
WHEN alert_rate >= 0.30 AND tot_investigated <= 3 THEN '{vocab.NOTE_TINY_VOLUME}' ELSE 'ok' END"""
LEVEL = """CASE WHEN anomaly_votes = 4 THEN 'CRITICAL' WHEN alert_rate >= t_high AND tot_investigated >= t_vol THEN 'HIGH'
WHEN anomaly_votes >= 3 AND alert_rate >= pop_median THEN 'HIGH' WHEN alert_rate >= t_med OR anomaly_votes >= 3 THEN 'MEDIUM' ELSE 'LOW' END"""
THRESHOLDS = f"""{FLAGGED}, base AS (SELECT median(alert_rate) AS pop_median, min(alert_rate) AS rlo, max(alert_rate) AS rhi FROM scored),
sub AS (SELECT quantile_cont(alert_rate, 0.33) AS p33, quantile_cont(alert_rate, 0.66) AS p66, quantile_cont(tot_investigated, 0.25) AS vol_p25,
        min(ln(1 + alert_rate * tot_investigated)) AS alo, max(ln(1 + alert_rate * tot_investigated)) AS ahi FROM scored WHERE anomaly_consensus = 1),
thr AS (SELECT *, greatest(3.0 * pop_median, p66) AS t_high, greatest(1.5 * pop_median, p33) AS t_med, greatest(2.0, vol_p25) AS t_vol FROM base CROSS JOIN sub)"""
POST = f"""{THRESHOLDS}, ci AS (SELECT *, {LEVEL} AS risk_level, {NOTE} AS quality_note, {LOW} AS ci95_low, {HIGH} AS ci95_high,
        alert_rate * tot_investigated AS absolute_alarms FROM scored CROSS JOIN thr WHERE anomaly_consensus = 1),
tight AS (SELECT *, COALESCE(ci95_high - ci95_low, 1.0) AS ci_width, greatest(0.0, 1 - COALESCE(ci95_high - ci95_low, 1.0)) AS ci_tightness,
        (alert_rate - rlo) / greatest(rhi - rlo, 1e-9) AS rate_n,
        CASE WHEN ahi > alo THEN (ln(1 + absolute_alarms) - alo) / (ahi - alo) ELSE 0.0 END AS alarms_n FROM ci),
prio AS (SELECT *, round_even((0.60 * rate_n + 0.40 * alarms_n) * ci_tightness, 4) AS priority_score FROM tight),
post AS (SELECT *, row_number() OVER (ORDER BY priority_score DESC, {KEYS}) AS rank FROM prio),
clean AS (SELECT * FROM post WHERE quality_note NOT IN ('{vocab.NOTE_INCOMPLETE}', '{vocab.NOTE_FALSE_POSITIVE}'))"""


def _voted(spark, sf):
    return materialize(voted_routes(spark, sf))


def _post(spark, sf):
    return G.apply_post_processing(_voted(spark, sf))


@query("consensus_subset", f"{FLAGGED} SELECT route, anomaly_votes FROM scored WHERE anomaly_consensus = 1")
def _(spark, sf):
    return G.consensus_subset(voted_routes(spark, sf)).select("route", "anomaly_votes")


_THR = ["pop_median", "p33", "p66", "vol_p25", "t_high", "t_med", "t_vol"]


@query("risk_thresholds", f"{THRESHOLDS} SELECT {', '.join(f'{R(c)} AS {c}' for c in _THR)} FROM thr")
def _(spark, sf):
    return G.risk_thresholds(_voted(spark, sf)).select(*[r6(c) for c in _THR])


@query("risk_levels", f"{POST} SELECT route, risk_level FROM post")
def _(spark, sf):
    scored = _voted(spark, sf)
    return G.with_risk_level(G.consensus_subset(scored), G.risk_thresholds(scored)).select("route", "risk_level")


# Levels and notes of every route, so that all branches occur.
@query("risk_levels_all_routes", f"{THRESHOLDS} SELECT route, {LEVEL} AS risk_level, {NOTE} AS quality_note FROM scored CROSS JOIN thr")
def _(spark, sf):
    scored = _voted(spark, sf)
    out = G.with_confidence(G.with_risk_level(scored, G.risk_thresholds(scored)))
    return out.select("route", "risk_level", "quality_note")


@query("quality_notes", f"{FLAGGED} SELECT route, {NOTE} AS quality_note FROM scored")
def _(spark, sf):
    return G.with_confidence(voted_routes(spark, sf)).select("route", "quality_note")


@query(
    "wilson_intervals",
    f"{FLAGGED} SELECT route, {R(LOW)} AS ci95_low, {R(HIGH)} AS ci95_high, CASE WHEN tot_investigated > 0 THEN printf('[%.1f%%, %.1f%%]', 100 * ({LOW}), 100 * ({HIGH})) ELSE 'n/a' END AS ci95_str FROM scored",
)
def _(spark, sf):
    return G.with_confidence(routes_of(spark, sf)).select("route", r6("ci95_low"), r6("ci95_high"), "ci95_str")


@query("interval_tightness", f"{POST} SELECT route, {R('ci_width')} AS ci_width, {R('ci_tightness')} AS ci_tightness FROM tight")
def _(spark, sf):
    out = G.with_confidence(G.consensus_subset(voted_routes(spark, sf)))
    return out.select("route", r6("ci_width"), r6("ci_tightness"))


@query("absolute_alarms", f"{FLAGGED} SELECT route, {R('alert_rate * tot_investigated')} AS absolute_alarms, {R('ln(1 + alert_rate * tot_investigated)')} AS absolute_alarms_log FROM scored")
def _(spark, sf):
    return G.absolute_alarms(routes_of(spark, sf)).select("route", r6("absolute_alarms"), r6("absolute_alarms_log"))


@query("priority_inputs", f"{POST} SELECT route, {R('rate_n')} AS rate_n, {R('alarms_n')} AS alarms_n FROM tight")
def _(spark, sf):
    return G.normalise_for_priority(_voted(spark, sf)).select("route", r6("rate_n"), r6("alarms_n"))


@query("priority_scores", f"{POST} SELECT route, {R('priority_score')} AS priority_score FROM prio")
def _(spark, sf):
    out = G.priority_score(G.with_confidence(G.normalise_for_priority(_voted(spark, sf))))
    return out.select("route", r6("priority_score"))


@query("priority_rank", f"{POST} SELECT route, rank FROM post")
def _(spark, sf):
    return _post(spark, sf)[0].select("route", "rank")


@query("route_rank_by_volume", f"{FLAGGED} SELECT route, row_number() OVER (ORDER BY tot_entries DESC, {KEYS}) AS rank FROM scored")
def _(spark, sf):
    """Global rank over range partitions, as used beyond one task's capacity."""
    order = [F.desc("tot_entries"), F.asc("departure_airport_iata"), F.asc("arrival_airport_iata")]
    return global_rank(routes_of(spark, sf), order, max_rows=100).select("route", "rank")


@query("ranked_clean", f"{POST} SELECT route, rank, risk_level, {R('priority_score')} AS priority_score FROM clean")
def _(spark, sf):
    return G.drop_disqualified(_post(spark, sf)[0]).select("route", "rank", "risk_level", r6("priority_score"))


@query(
    "post_processing",
    f"{POST} SELECT route, rank, risk_level, quality_note, {R('ci95_low')} AS ci95_low, {R('ci95_high')} AS ci95_high, {R('absolute_alarms')} AS absolute_alarms, {R('priority_score')} AS priority_score FROM post",
)
def _(spark, sf):
    return _post(spark, sf)[0].select(
        "route", "rank", "risk_level", "quality_note", r6("ci95_low"), r6("ci95_high"), r6("absolute_alarms"), r6("priority_score")
    )


_LEVELS = ", ".join(f"({i}, '{v}')" for i, v in enumerate(vocab.RISK_LEVELS, 1))


@query(
    "risk_distribution",
    f"{POST} SELECT l.level_order, l.risk_level, count(c.route) AS n FROM (VALUES {_LEVELS}) AS l(level_order, risk_level) LEFT JOIN clean c ON c.risk_level = l.risk_level GROUP BY 1, 2",
)
def _(spark, sf):
    return G.risk_distribution(_post(spark, sf)[1])


# A stricter note stands in for the disqualified ones, which this data lacks.
@query("excluded_routes", f"{POST} SELECT route, quality_note, risk_level FROM post WHERE risk_level <> 'HIGH'")
def _(spark, sf):
    post = materialize(_post(spark, sf)[0])
    return G.excluded(post, post.filter(F.col("risk_level") == "HIGH")).select("route", "quality_note", "risk_level")


# Every route counts as consensus here, so that all disqualifying notes occur.
@query(
    "disqualified_routes",
    f"{FLAGGED} SELECT route, {NOTE} AS quality_note FROM scored WHERE {NOTE} IN ('{vocab.NOTE_INCOMPLETE}', '{vocab.NOTE_FALSE_POSITIVE}')",
)
def _(spark, sf):
    every = materialize(G.with_confidence(voted_routes(spark, sf)))
    return G.excluded(every, G.drop_disqualified(every)).select("route", "quality_note")


@query("qualified_routes", f"{FLAGGED} SELECT route, {NOTE} AS quality_note FROM scored WHERE {NOTE} NOT IN ('{vocab.NOTE_INCOMPLETE}', '{vocab.NOTE_FALSE_POSITIVE}')")
def _(spark, sf):
    return G.drop_disqualified(G.with_confidence(voted_routes(spark, sf))).select("route", "quality_note")


@query(
    "run_summary",
    f"{POST} SELECT (SELECT count(*) FROM scored) AS n_routes, (SELECT count(*) FROM scored WHERE anomaly_votes >= 3) AS n_votes_3, (SELECT count(*) FROM post) AS n_consensus, "
    "(SELECT count(*) FROM clean) AS n_clean, " + ", ".join(f"(SELECT count(*) FROM clean WHERE risk_level = '{v}') AS n_{v.lower()}" for v in vocab.RISK_LEVELS)
    + ", (SELECT count(*) FROM post) - (SELECT count(*) FROM clean) AS n_excluded",
)
def _(spark, sf):
    scored = _voted(spark, sf)
    post, clean = G.apply_post_processing(scored)
    return G.run_summary(scored, post, clean)


@query("ranked_routes")
def _(spark, sf):
    """The whole analysis, forest included: ranked clean routes."""
    run = run_routes(view(spark, sf, "alarms"), view(spark, sf, "travelers"), CATEGORIES)
    return run.clean.select(
        "rank", "route", "departure_country", r6("alert_rate"), "ci95_str", n64("tot_investigated"), "anomaly_votes", "risk_level", r6("priority_score"), "quality_note"
    )
