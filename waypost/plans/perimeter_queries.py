"""Perimeter filters, request resolution, batched runs, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waypost.operators import perimeters as H
from waypost.operators import ranking as G
from waypost.operators import reports as RP
from waypost.operators.detectors import FLAGS, flag_top
from waypost.operators.routes import alarm_routes, combine_sides, country_top_iata, reduce_alarms, reduce_travelers
from waypost.plans.fixtures import CATEGORIES, TOKEN, table, view, with_views
from waypost.plans.ranking_queries import POST, _voted
from waypost.plans.registry import R, n64, query, r6
from waypost.plans.route_queries import KEYS, ROUTE_MASTER, TRAVELER_COLS
from waypost.plans.runs import SCOPE, run_perimeters, run_routes
from waypost.session import materialize
from waypost.sources import dims as DM
from waypost.sources import vocab

TRAV_ID = "departure_date, departure_airport_iata, arrival_airport_iata, nationality, control_outcome, document_type2, zone"
FILTER = {"airport_iata": [" s03", "S04"], "nationality": "building ", "age_band": "x", "planet": "mars"}


@query(
    "perimeter_travelers",
    f"{with_views('travelers')} SELECT {TRAV_ID}, entries FROM travelers WHERE departure_airport_iata IN ('S03', 'S04') AND nationality = 'BUILDING'",
)
def _(spark, sf):
    return H.apply_perimeter(view(spark, sf, "travelers"), FILTER, "travelers").select(*TRAV_ID.split(", "), "entries")


@query("perimeter_alarms", f"{with_views('alarms')} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM alarms WHERE departure_airport_iata IN ('S03', 'S04')")
def _(spark, sf):
    return H.apply_perimeter(view(spark, sf, "alarms"), FILTER, "alarms").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "perimeter_months",
    f"{with_views('travelers')} SELECT {TRAV_ID}, entries FROM travelers WHERE month(departure_date) IN (1, 2) AND year(departure_date) = 1995",
)
def _(spark, sf):
    t = view(spark, sf, "travelers").withColumns(
        {"departure_month": F.lpad(F.month("departure_date").cast("string"), 2, "0"), "departure_year": F.year("departure_date").cast("string")}
    )
    return H.apply_perimeter(t, {"month": [1, 2], "year": 1995}).select(*TRAV_ID.split(", "), "entries")


@query("ignored_perimeter_keys", f"{with_views('alarms')} SELECT 'alarms' AS side, k AS ignored_key, n FROM (VALUES ('nationality'), ('age_band'), ('planet')) AS v(k) CROSS JOIN (SELECT count(*) AS n FROM alarms)")
def _(spark, sf):
    a = view(spark, sf, "alarms")
    n = a.agg(F.count(F.lit(1)).alias("n"))
    return H.ignored_keys(spark, a.columns, FILTER, "alarms").withColumn("n", n.scalar())


REQ = f"""{with_views("requests", "airports", "alarms")},
ctop AS (SELECT country, departure_airport_iata AS iata FROM (SELECT upper(departure_country) AS country, departure_airport_iata,
   row_number() OVER (PARTITION BY upper(departure_country) ORDER BY count(*) DESC, departure_airport_iata) AS rn FROM alarms WHERE departure_airport_iata IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
cities AS (SELECT upper(city) AS city, max_by(iata, ord) AS iata, min(ord) AS ord FROM airports GROUP BY 1),
asked AS (SELECT *, upper(user_request) AS txt FROM requests),
tok AS (SELECT request_id, unnest(regexp_extract_all(txt, '\\b([A-Z][0-9]{{2}})\\b', 1)) AS code, generate_subscripts(regexp_extract_all(txt, '\\b([A-Z][0-9]{{2}})\\b', 1), 1) AS pos FROM asked),
s1 AS (SELECT request_id, min_by(code, pos) AS iata FROM tok WHERE code IN (SELECT iata FROM airports) GROUP BY 1),
s2 AS (SELECT request_id, iata FROM (SELECT request_id, c.iata, row_number() OVER (PARTITION BY request_id ORDER BY length(c.city) DESC, c.ord) AS rn FROM asked JOIN cities c ON regexp_matches(txt, '\\b' || c.city || '\\b')) WHERE rn = 1),
s3 AS (SELECT request_id, iata FROM (SELECT request_id, ctop.iata, row_number() OVER (PARTITION BY request_id ORDER BY length(n_name) DESC, n_nationkey) AS rn
       FROM asked JOIN nation ON regexp_matches(txt, '\\b' || n_name || '\\b') JOIN ctop ON ctop.country = n_name) WHERE rn = 1),
pick AS (SELECT requests.*, CASE WHEN trim(user_request) = '' THEN NULL ELSE COALESCE(s1.iata, s2.iata, s3.iata) END AS iata,
       CASE WHEN trim(user_request) = '' THEN 'global' WHEN s1.iata IS NOT NULL THEN 'code' WHEN s2.iata IS NOT NULL THEN 'city' WHEN s3.iata IS NOT NULL THEN 'country' END AS matched_by,
       CASE WHEN regexp_matches(user_request, '(?i)\\b(to|arrival|arriving|arriva|atterra|verso)\\b') THEN 'arrival' ELSE 'departure' END AS r
       FROM requests LEFT JOIN s1 USING (request_id) LEFT JOIN s2 USING (request_id) LEFT JOIN s3 USING (request_id)),
resolved AS (SELECT request_id, user_request, iata, CASE WHEN iata IS NOT NULL THEN r END AS role, matched_by,
       CASE WHEN matched_by = 'global' THEN 'global' WHEN iata IS NOT NULL THEN r || ':' || iata END AS perimeter_id FROM pick)"""


def request_dims(spark: SparkSession, sf: str) -> H.RequestDims:
    directory = view(spark, sf, "airports")
    countries = table(spark, sf, "nation").select(F.col("n_name").alias("country"), F.col("n_nationkey").alias("ord"))
    return H.RequestDims(directory, DM.city_codes(directory), countries)


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    top = country_top_iata(view(spark, sf, "alarms"))
    return H.resolve_requests(view(spark, sf, "requests"), request_dims(spark, sf), top, TOKEN)


@query("resolved_requests", f"{REQ} SELECT request_id, user_request, iata, role, matched_by, perimeter_id FROM resolved")
def _(spark, sf):
    return _resolved(spark, sf).select("request_id", "user_request", "iata", "role", "matched_by", "perimeter_id")


@query("city_codes", f"{with_views('airports')} SELECT upper(city) AS city, max_by(iata, ord) AS iata, CAST(min(ord) AS INT) AS ord FROM airports GROUP BY 1")
def _(spark, sf):
    return DM.city_codes(view(spark, sf, "airports")).withColumn("ord", F.col("ord").cast("int"))


@query("request_roles", "SELECT conv_id, turn, CASE WHEN regexp_matches(text, '(?i)\\b(to|arrival|arriving|arriva|atterra|verso)\\b') THEN 'arrival' ELSE 'departure' END AS role FROM conversations")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", H.request_role(F.col("text")).alias("role"))


COUNTED = f"""{REQ.replace('WITH ', with_views('travelers') + ', ', 1)},
ca AS (SELECT pid, count(*) AS n_alarms FROM (SELECT unnest(['departure:' || departure_airport_iata, 'arrival:' || arrival_airport_iata, 'global']) AS pid FROM alarms) GROUP BY 1),
ct AS (SELECT pid, count(*) AS n_travelers FROM (SELECT unnest(['departure:' || departure_airport_iata, 'arrival:' || arrival_airport_iata, 'global']) AS pid FROM travelers) GROUP BY 1),
status AS (SELECT request_id, perimeter_id, role, iata, COALESCE(n_alarms, 0) AS n_alarms, COALESCE(n_travelers, 0) AS n_travelers,
   CASE WHEN perimeter_id IS NULL THEN 'invalid_input' WHEN COALESCE(n_alarms, 0) + COALESCE(n_travelers, 0) = 0 AND perimeter_id <> 'global' THEN 'empty_perimeter' ELSE 'ready' END AS status
   FROM resolved LEFT JOIN ca ON ca.pid = perimeter_id LEFT JOIN ct ON ct.pid = perimeter_id)"""


@query(
    "perimeter_status",
    f"{COUNTED} SELECT request_id, perimeter_id, n_alarms, n_travelers, status, CASE status WHEN 'invalid_input' THEN '{H.NO_MATCH}' WHEN 'empty_perimeter' THEN 'No records found for ' || role || ' IATA = ' || iata || '.' END AS reason FROM status",
)
def _(spark, sf):
    counts = H.perimeter_row_counts(view(spark, sf, "alarms"), view(spark, sf, "travelers"))
    out = H.perimeter_status(_resolved(spark, sf), counts)
    return out.select("request_id", "perimeter_id", "n_alarms", "n_travelers", "status", "reason")


READY = f"{COUNTED}, ready AS (SELECT DISTINCT perimeter_id FROM status WHERE status = 'ready')"
TAG = "SELECT unnest(['departure:' || departure_airport_iata, 'arrival:' || arrival_airport_iata, 'global']) AS perimeter_id, * FROM"
TAGGED = f"{READY}, tt AS (SELECT * FROM ({TAG} coded_travelers) SEMI JOIN ready USING (perimeter_id)), ta AS (SELECT * FROM ({TAG} coded_alarms) SEMI JOIN ready USING (perimeter_id))"


def _tagged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    a, t = materialize(reduce_alarms(view(spark, sf, "alarms"))), materialize(reduce_travelers(view(spark, sf, "travelers")))
    asked = H.perimeter_status(_resolved(spark, sf), H.perimeter_row_counts(a, t, "n"))
    ready = materialize(asked.filter(F.col("status") == "ready").select(SCOPE))
    return H.tag_perimeters(a, ready), H.tag_perimeters(t, ready)


def _slot_sql(col: str, k: int) -> str:
    return (
        f"SELECT perimeter_id, '{col}' AS kind, rn AS slot, value, n FROM (SELECT perimeter_id, {col} AS value, count(*) AS n, row_number() OVER (PARTITION BY perimeter_id ORDER BY count(*) DESC, {col}) AS rn "
        f"FROM tt GROUP BY perimeter_id, {col}) WHERE rn <= {k} AND value <> 'Unknown'"
    )


SLOTS = f"{TAGGED}, slots AS ({_slot_sql('nationality', 3)} UNION ALL {_slot_sql('document_type2', 3)} UNION ALL {_slot_sql('control_outcome', 4)})"


@query("perimeter_category_slots", f"{SLOTS} SELECT * FROM slots")
def _(spark, sf):
    return H.category_slots(_tagged(spark, sf)[1])


def _slot_rate(flag: str) -> str:
    den = f"SUM(CASE WHEN {flag} THEN investigated END)"
    return f"CASE WHEN {den} > 0 THEN CAST(SUM(CASE WHEN {flag} THEN alarms END) AS DOUBLE) / {den} END"


_SLOT_COLS = (
    [(f"alert_rate_nat_{i}", _slot_rate(f"nat = {i}")) for i in (1, 2, 3)]
    + [(f"pct_nat_{i}", f"CAST(count(CASE WHEN nat = {i} THEN 1 END) AS DOUBLE) / count(*)") for i in (1, 2, 3)]
    + [(f"alert_rate_doc_{i}", _slot_rate(f"doc = {i}")) for i in (1, 2, 3)]
    + [(f"pct_outcome_{i}", f"CAST(count(CASE WHEN co = {i} THEN 1 END) AS DOUBLE) / count(control_outcome)") for i in (1, 2, 3, 4)]
)


@query(
    "perimeter_traveler_routes",
    f"{SLOTS}, w AS (SELECT tt.*, a.slot AS nat, b.slot AS doc, c.slot AS co FROM tt LEFT JOIN slots a ON a.kind = 'nationality' AND a.perimeter_id = tt.perimeter_id AND a.value = nationality "
    "LEFT JOIN slots b ON b.kind = 'document_type2' AND b.perimeter_id = tt.perimeter_id AND b.value = document_type2 LEFT JOIN slots c ON c.kind = 'control_outcome' AND c.perimeter_id = tt.perimeter_id AND c.value = control_outcome) "
    f"SELECT perimeter_id, {KEYS}, CAST(SUM(entries) AS BIGINT) AS tot_entries, count(*) AS n_records, {', '.join(f'{R(e)} AS {n}' for n, e in _SLOT_COLS)} FROM w GROUP BY perimeter_id, {KEYS}",
)
def _(spark, sf):
    out = H.traveler_routes_by_perimeter(materialize(_tagged(spark, sf)[1]))
    return out.select(SCOPE, *KEYS.split(", "), "tot_entries", "n_records", *[r6(n) for n, _ in _SLOT_COLS])


# Ranking of every perimeter with a flag SQL can express: both sides of the
# threshold rules use the perimeter's own routes.
_PR = f"""{TAGGED}, ts AS (SELECT perimeter_id, {KEYS}, {", ".join(f'{e} AS "{n}"' for n, e in TRAVELER_COLS[:7])} FROM tt GROUP BY perimeter_id, {KEYS}),
als AS (SELECT perimeter_id, {KEYS} FROM ta GROUP BY perimeter_id, {KEYS} HAVING count(occurrences) > 0),
pr AS (SELECT perimeter_id, {KEYS}, COALESCE(alert_rate, 0) AS alert_rate, COALESCE(tot_investigated, 0) AS tot_investigated FROM als FULL JOIN ts USING (perimeter_id, {KEYS})),
fl AS (SELECT *, CASE WHEN alert_rate > quantile_cont(alert_rate, 0.8) OVER (PARTITION BY perimeter_id) THEN 2 ELSE 0 END AS anomaly_votes FROM pr),
med AS (SELECT perimeter_id, median(alert_rate) AS pop_median FROM fl GROUP BY 1),
sub AS (SELECT perimeter_id, quantile_cont(alert_rate, 0.33) AS p33, quantile_cont(alert_rate, 0.66) AS p66, quantile_cont(tot_investigated, 0.25) AS v FROM fl WHERE anomaly_votes = 2 GROUP BY 1)"""


@query(
    "perimeter_thresholds",
    f"{_PR} SELECT perimeter_id, {R('pop_median')} AS pop_median, {R('greatest(3.0 * pop_median, p66)')} AS t_high, {R('greatest(1.5 * pop_median, p33)')} AS t_med, {R('greatest(2.0, v)')} AS t_vol FROM med JOIN sub USING (perimeter_id)",
)
def _(spark, sf):
    tagged_a, tagged_t = _tagged(spark, sf)
    routes = combine_sides(alarm_routes(tagged_a, CATEGORIES.occurrences, [SCOPE]), H.traveler_routes_by_perimeter(materialize(tagged_t)), [SCOPE])
    flagged = flag_top(materialize(routes), "alert_rate", 0.2, "anomaly_consensus", [SCOPE])
    out = G.risk_thresholds(materialize(flagged), [SCOPE]).filter(F.col("p33").isNotNull())
    return out.select(SCOPE, r6("pop_median"), r6("t_high"), r6("t_med"), r6("t_vol"))


@query(
    "perimeter_counts",
    f"{_PR} SELECT perimeter_id, count(*) AS n_routes, {R('max(alert_rate)')} AS max_alert_rate FROM pr GROUP BY 1",
)
def _(spark, sf):
    a, t = _tagged(spark, sf)
    routes = combine_sides(alarm_routes(a, CATEGORIES.occurrences, [SCOPE]), H.traveler_routes_by_perimeter(materialize(t)), [SCOPE])
    return routes.groupBy(SCOPE).agg(F.count(F.lit(1)).alias("n_routes"), r6(F.max("alert_rate"), "max_alert_rate"))


def _batched(spark: SparkSession, sf: str):
    return run_perimeters(
        view(spark, sf, "requests"), view(spark, sf, "alarms"), view(spark, sf, "travelers"), request_dims(spark, sf), token=TOKEN, occurrences=CATEGORIES.occurrences
    )


@query("perimeter_runs")
def _(spark, sf):
    """All requested perimeters with all detectors, in one job."""
    return _batched(spark, sf).scored.select(SCOPE, "route", *FLAGS, "anomaly_votes", r6("if_score"), r6("lof_score"))


@query("perimeter_reports")
def _(spark, sf):
    return _batched(spark, sf).reports


@query(
    "perimeter_run_checks",
    f"{_PR} SELECT perimeter_id, count(*) AS n_routes, count(*) >= {vocab.MIN_ROUTES} AS scored, TRUE AS votes_add_up, TRUE AS flags_within_share FROM pr GROUP BY 1",
)
def _(spark, sf):
    """Every perimeter of a batched run: its routes, whether it is scored at all, its votes, and no more forest and LOF flags than the contamination allows."""
    scored = _batched(spark, sf).scored
    votes = sum((F.col(f) for f in FLAGS[1:]), F.col(FLAGS[0]))
    most = F.ceil(F.lit(vocab.CONTAMINATION) * F.count(F.lit(1)))
    return scored.groupBy(SCOPE).agg(
        F.count(F.lit(1)).alias("n_routes"), F.bool_or(F.col("if_score").isNotNull()).alias("scored"), F.bool_and(F.col("anomaly_votes") == votes).alias("votes_add_up"),
        ((F.sum("if_anomaly") <= most) & (F.sum("lof_anomaly") <= most)).alias("flags_within_share"),
    )


@query(
    "perimeter_report_checks",
    f"{_PR}, n AS (SELECT perimeter_id, count(*) AS n_routes FROM pr GROUP BY 1) SELECT request_id, status, "
    f"CASE WHEN status = 'ready' THEN CAST(coalesce(n_routes, 0) AS VARCHAR) END AS routes_named, CASE WHEN status <> 'ready' THEN CASE status WHEN 'invalid_input' THEN '{H.NO_MATCH}' ELSE 'No records found for ' || role || ' IATA = ' || iata || '.' END END AS reason_named "
    "FROM status LEFT JOIN n USING (perimeter_id)",
)
def _(spark, sf):
    """The numbers and reasons that the reports of a batched run name, read out of their texts."""
    reports = _batched(spark, sf).reports
    routes, reason = F.regexp_extract("report_md", r"Routes analysed: \*\*(\d+)\*\*", 1), F.regexp_extract("report_md", r"\*\*Reason\*\*: (.*)\n", 1)
    return reports.select("request_id", "status", F.nullif(routes, F.lit("")).alias("routes_named"), F.nullif(reason, F.lit("")).alias("reason_named"))


@query(
    "report_payload",
    f"{POST}, lv AS (SELECT risk_level, count(*) AS n FROM clean GROUP BY 1) SELECT (SELECT count(*) FROM scored) AS n_routes, (SELECT count(*) FROM clean) AS n_consensus, "
    f"(SELECT string_agg(risk_level || '=' || n, ',' ORDER BY n DESC, {' '.join(['CASE risk_level'] + [f'WHEN {chr(39)}{v}{chr(39)} THEN {i}' for i, v in enumerate(vocab.RISK_LEVELS)] + ['END'])}) FROM lv) AS distribution, "
    "(SELECT string_agg(route, ',' ORDER BY rank) FROM (SELECT route, rank FROM clean ORDER BY rank LIMIT 10)) AS top_routes",
)
def _(spark, sf):
    scored = _voted(spark, sf)
    clean = materialize(G.apply_post_processing(scored)[1])
    payload = RP.report_payload(scored, clean)
    return payload.select(
        "n_routes", "n_consensus",
        F.array_join(F.transform("distribution", lambda s: F.concat(s["risk_level"], F.lit("="), s["n"].cast("string"))), ",").alias("distribution"),
        F.array_join(F.transform("top", lambda r: r["route"]), ",").alias("top_routes"),
    )


def _trimmed(c: str) -> str:
    return f"coalesce(regexp_replace(regexp_replace(printf('%.6f', CAST({c} AS DOUBLE)), '0+$', ''), '[.]$', ''), 'null')"


_TOP_SQL = {c: f"coalesce(CAST({c} AS VARCHAR), '')" for c in RP.TOP_COLUMNS} | {c: _trimmed(c) for c in ("alert_rate", "absolute_alarms", "priority_score", "tot_investigated")}
_TOP_SQL["ci95_str"] = "CASE WHEN tot_investigated > 0 THEN printf('[%.1f%%, %.1f%%]', 100 * ci95_low, 100 * ci95_high) ELSE 'n/a' END"
_TOP_LINE = " || ' | ' || ".join(_TOP_SQL.values())
_LEVEL_ORDER = " ".join(["CASE risk_level", *[f"WHEN '{v}' THEN {i}" for i, v in enumerate(vocab.RISK_LEVELS)], "END"])
_COUNT_LINES = " || ',' || chr(10) || ".join(
    [f"""'  "{f}": ' || sum({f})""" for f in FLAGS] + [f"""'  "consensus_>={n}": ' || count_if(anomaly_votes >= {n})""" for n in (2, 3)]
)
_REPORT_PARTS = [
    f"'{RP.TITLE}'", "''", "'## Perimeter'", "chr(123) || chr(125)", "''", "'## Summary'", "'- Routes analysed: **' || n_routes || '**'",
    "'- Consensus anomalies (≥ 2/4 detectors): **' || n_clean || '**'", "'- Risk distribution: ' || levels", "''", "'## Detector counts'", "counts", "''",
    "'## Top-10 ranked anomalies'", f"coalesce('| {' | '.join(RP.TOP_COLUMNS)} |' || chr(10) || '|{'|'.join('---' for _ in RP.TOP_COLUMNS)}|' || chr(10) || lines, '{RP.NO_ANOMALIES}')", "''",
    "'## Interpretation'", f"'{RP.INTERPRETATION}'", "''",
]
_REPORT = f"""{POST}, lv AS (SELECT risk_level, count(*) AS n FROM clean GROUP BY 1),
dist AS (SELECT chr(123) || coalesce(string_agg(chr(39) || risk_level || chr(39) || ': ' || n, ', ' ORDER BY n DESC, {_LEVEL_ORDER}), '') || chr(125) AS levels FROM lv),
best AS (SELECT string_agg('| ' || {_TOP_LINE} || ' |', chr(10) ORDER BY rank) AS lines FROM (SELECT * FROM clean ORDER BY rank LIMIT 10)),
found AS (SELECT count(*) AS n_routes, chr(123) || chr(10) || {_COUNT_LINES} || chr(10) || chr(125) AS counts FROM scored)
SELECT {" || chr(10) || ".join(_REPORT_PARTS)} AS report_md FROM found, dist, best, (SELECT count(*) AS n_clean FROM clean)"""


@query("rendered_report", _REPORT)
def _(spark, sf):
    scored = _voted(spark, sf)
    clean = materialize(G.apply_post_processing(scored)[1])
    return RP.render_report(RP.report_payload(scored, clean), F.lit("{}")).select("report_md")


_AUDIT = (
    f"{with_views('travelers', 'alarms')} SELECT 'alarms' AS stage, count(*) AS n_rows, '{{\"flights\":' || CAST(SUM(total_flights) AS BIGINT) || '}}' AS metrics FROM alarms UNION ALL SELECT 'travelers', count(*), '{{}}' FROM travelers"
)


@query("audit_log", _AUDIT)
def _(spark, sf):
    return RP.audit_log(
        [RP.audit("alarms", view(spark, sf, "alarms"), flights=F.sum("total_flights")), RP.audit("travelers", view(spark, sf, "travelers"))]
    )


@query("observed_audit", _AUDIT)
def _(spark, sf):
    """Counts and metrics taken while the tables are written."""
    seen = {"alarms": Observation(), "travelers": Observation()}
    materialize(view(spark, sf, "alarms"), seen["alarms"], flights=F.sum("total_flights"))
    materialize(view(spark, sf, "travelers"), seen["travelers"])
    return RP.audit_observed(spark, seen)


@query("run_audit", f"{ROUTE_MASTER} SELECT 'routes' AS stage, count(*) AS n_rows FROM routes UNION ALL SELECT 'detectors', count(*) FROM routes")
def _(spark, sf):
    """What the writes of a whole run saw of its first stages."""
    audit = run_routes(view(spark, sf, "alarms"), view(spark, sf, "travelers"), CATEGORIES).audit
    return audit.where("stage <> 'ranking'").select("stage", "n_rows")
