"""Route-level aggregates and the feature matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.operators import features as X
from waypost.operators import routes as D
from waypost.plans.fixtures import CATEGORIES, CODED, view, with_views
from waypost.plans.registry import R, n64, query, r6
from waypost.sources.files import q

KEYS = "departure_airport_iata, arrival_airport_iata"
OCC = CATEGORIES.occurrences
NAT, DOC, OUT = CATEGORIES.nationalities, CATEGORIES.documents, CATEGORIES.outcomes

OCC_SUMS = ", ".join(
    f"CAST(COALESCE(SUM(CASE WHEN occurrences = '{v}' THEN total_flights END), 0) AS BIGINT) AS tot_{v}" for v in OCC
)


def _rate(cond: str) -> str:
    num = f"SUM(CASE WHEN {cond} THEN alarms END)"
    den = f"SUM(CASE WHEN {cond} THEN investigated END)"
    return f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END)"


NAT_RATES = [(f"alert_rate_{v}", _rate(f"nationality = '{v}'")) for v in NAT]
NAT_SHARES = [(f"pct_nat_{v}", f"(CAST(count(CASE WHEN nationality = '{v}' THEN 1 END) AS DOUBLE) / count(*))") for v in NAT]
DOC_RATES = [(f"alert_rate_doc_{v}", _rate(f"document_type2 = '{v}'")) for v in DOC]
OUT_SHARES = [
    (f"pct_{v}", f"COALESCE(CAST(count(CASE WHEN control_outcome = '{v}' THEN 1 END) AS DOUBLE) / NULLIF(count(control_outcome), 0), 0)") for v in OUT
]
TOTALS = [
    ("tot_entries", "CAST(SUM(entries) AS BIGINT)"), ("tot_investigated", "CAST(SUM(investigated) AS BIGINT)"),
    ("tot_alarms", "CAST(SUM(alarms) AS BIGINT)"), ("n_records", "count(*)"),
]
RATES = [
    ("alarm_intensity", _rate("TRUE")),
    ("alert_rate", f"(CASE WHEN {_rate('TRUE')} IS NOT NULL THEN least({_rate('TRUE')}, 1.0) END)"),
    ("investigation_rate", "(CASE WHEN SUM(entries) > 0 THEN CAST(SUM(investigated) AS DOUBLE) / CAST(SUM(entries) AS DOUBLE) END)"),
]
TRAVELER_COLS = TOTALS + RATES + NAT_RATES + NAT_SHARES + DOC_RATES + OUT_SHARES


def _list(cols: list[tuple[str, str]], rounded: bool = False) -> str:
    return ", ".join(f"{R(e) if rounded else e} AS \"{n}\"" for n, e in cols)


TRAVELER_SIDE = f"t_side AS (SELECT {KEYS}, {_list(TRAVELER_COLS)} FROM coded_travelers GROUP BY {KEYS})"
ALARM_SIDE = f"""
zone_n AS (SELECT {KEYS}, zone, row_number() OVER (PARTITION BY {KEYS} ORDER BY count(*) DESC, zone) AS rn
           FROM coded_alarms WHERE zone IS NOT NULL GROUP BY {KEYS}, zone),
reason_n AS (SELECT {KEYS}, alarm_reason, row_number() OVER (PARTITION BY {KEYS} ORDER BY count(*) DESC, alarm_reason) AS rn
             FROM coded_alarms WHERE alarm_reason IS NOT NULL GROUP BY {KEYS}, alarm_reason),
descr AS (SELECT {KEYS}, min(departure_country) AS departure_country, z.zone AS zone,
                 count(CASE WHEN risk_flag = 'HIGH RISK' THEN 1 END) AS n_high_risk,
                 count(CASE WHEN risk_flag = 'MEDIUM RISK' THEN 1 END) AS n_medium_risk,
                 r.alarm_reason AS alarm_reason_top
          FROM coded_alarms a LEFT JOIN (SELECT * FROM zone_n WHERE rn = 1) z USING ({KEYS})
               LEFT JOIN (SELECT * FROM reason_n WHERE rn = 1) r USING ({KEYS})
          GROUP BY {KEYS}, z.zone, r.alarm_reason),
pivoted AS (SELECT {KEYS}, {OCC_SUMS} FROM coded_alarms GROUP BY {KEYS} HAVING count(occurrences) > 0),
a_side AS (SELECT * FROM pivoted JOIN descr USING ({KEYS}))
""".replace("coded_alarms a LEFT JOIN", "(SELECT * RENAME (zone AS zone_raw, alarm_reason AS reason_raw) FROM coded_alarms) a LEFT JOIN")
NUMERIC = [f"tot_{v}" for v in OCC] + ["n_high_risk", "n_medium_risk", "zone"] + [n for n, _ in TRAVELER_COLS]
ROUTE_MASTER = f"""{with_views("travelers", "alarms")}, {TRAVELER_SIDE}, {ALARM_SIDE},
routes AS (SELECT COALESCE(a.departure_airport_iata, t.departure_airport_iata) AS departure_airport_iata,
                  COALESCE(a.arrival_airport_iata, t.arrival_airport_iata) AS arrival_airport_iata,
                  a.departure_country, a.alarm_reason_top,
                  {", ".join(f'COALESCE("{c}", 0) AS "{c}"' for c in NUMERIC)},
                  CASE WHEN a.departure_airport_iata IS NULL THEN 'right_only'
                       WHEN t.departure_airport_iata IS NULL THEN 'left_only' ELSE 'both' END AS data_coverage,
                  COALESCE(a.departure_airport_iata, t.departure_airport_iata) || '→'
                  || COALESCE(a.arrival_airport_iata, t.arrival_airport_iata) AS route
           FROM a_side a FULL JOIN t_side t ON a.departure_airport_iata = t.departure_airport_iata
                AND a.arrival_airport_iata = t.arrival_airport_iata)"""

FLOATS = [n for n, _ in RATES + NAT_RATES + NAT_SHARES + DOC_RATES + OUT_SHARES]
COUNTS = [c for c in NUMERIC if c not in FLOATS]
ROUTE_OUTPUT = (
    f"SELECT {KEYS}, route, departure_country, alarm_reason_top, data_coverage, "
    + ", ".join(f'CAST("{c}" AS BIGINT) AS "{c}"' for c in COUNTS)
    + ", "
    + ", ".join(f'{R(chr(34) + c + chr(34))} AS "{c}"' for c in FLOATS)
    + " FROM routes"
)


def routes_of(spark: SparkSession, sf: str) -> DataFrame:
    """Route master of the test views with frozen categories."""
    return D.build_route_master(view(spark, sf, "alarms"), view(spark, sf, "travelers"), CATEGORIES)


def show_routes(df: DataFrame) -> DataFrame:
    return df.select(
        *D.ROUTE, "route", "departure_country", "alarm_reason_top", "data_coverage",
        *[n64(c) for c in COUNTS], *[r6(c) for c in FLOATS],
    )


# Feature list of the matrix, in selection order.
FEATURES = (
    [f"tot_{v}" for v in OCC]
    + ["tot_entries", "tot_investigated", "tot_alarms"]
    + ["alert_rate"]
    + [x for v in NAT for x in (f"alert_rate_{v}", f"pct_nat_{v}")]
    + [f"alert_rate_doc_{v}" for v in DOC]
    + [f"pct_{v}" for v in OUT]
    + ["n_high_risk", "n_medium_risk", "alarm_intensity", "investigation_rate"]
)
LOGS = ", ".join(f'ln(1 + CAST("{c}" AS DOUBLE)) AS l{i}' for i, c in enumerate(FEATURES))
MATRIX = f"""{ROUTE_MASTER}, logs AS (SELECT route, {LOGS} FROM routes),
moments AS (SELECT {", ".join(f"avg(l{i}) AS mu{i}, stddev_pop(l{i}) AS sd{i}" for i in range(len(FEATURES)))} FROM logs),
matrix AS (SELECT route, {", ".join(f"CASE WHEN sd{i} > 0 THEN (l{i} - mu{i}) / sd{i} ELSE 0.0 END AS f{i}" for i in range(len(FEATURES)))}
           FROM logs CROSS JOIN moments)"""


@query("occurrence_pivot", f"{with_views('alarms')} SELECT {KEYS}, {OCC_SUMS} FROM coded_alarms GROUP BY {KEYS} HAVING count(occurrences) > 0")
def _(spark, sf):
    return D.pivot_occurrences(view(spark, sf, "alarms"), OCC)


@query(
    "route_descriptors",
    f"{with_views('alarms')}, {ALARM_SIDE} SELECT {KEYS}, departure_country, CAST(zone AS BIGINT) AS zone, n_high_risk, n_medium_risk, alarm_reason_top FROM descr",
)
def _(spark, sf):
    return D.route_descriptors(view(spark, sf, "alarms")).withColumn("zone", F.col("zone").cast("bigint"))


@query(
    "route_alarm_side",
    f"{with_views('alarms')}, {ALARM_SIDE} SELECT {KEYS}, {', '.join(f'tot_{v}' for v in OCC)}, departure_country, CAST(zone AS BIGINT) AS zone, n_high_risk, n_medium_risk, alarm_reason_top FROM a_side",
)
def _(spark, sf):
    out = D.join_route_parts(view(spark, sf, "alarms"), OCC)
    return out.withColumn("zone", F.col("zone").cast("bigint"))


def _top_sql(view_name: str, col: str, k: int, exclude: str = "") -> str:
    keep = f"AND value <> '{exclude}'" if exclude else ""
    return (
        f"{with_views(view_name)} SELECT value, n, place FROM (SELECT {col} AS value, count(*) AS n, "
        f"row_number() OVER (ORDER BY count(*) DESC, {col}) AS place FROM {view_name} WHERE {col} IS NOT NULL GROUP BY {col}) "
        f"WHERE place <= {k} {keep}"
    )


# One of the top values is excluded after the cut, so two rows remain.
@query("top_nationalities", _top_sql("travelers", "nationality", 3, "MACHINERY"))
def _(spark, sf):
    top = D.top_categories(view(spark, sf, "travelers"), "nationality", 3, ["MACHINERY"])
    return top.select("value", "n", n64("place"))


@query("top_documents", _top_sql("travelers", "document_type2", 3))
def _(spark, sf):
    return D.top_categories(view(spark, sf, "travelers"), "document_type2", 3).select("value", "n", n64("place"))


@query("top_outcomes", _top_sql("travelers", "control_outcome", 4))
def _(spark, sf):
    return D.top_categories(view(spark, sf, "travelers"), "control_outcome", 4).select("value", "n", n64("place"))


@query("route_traveler_totals", f"{with_views('travelers')} SELECT {KEYS}, {_list(TOTALS)}, {_list(RATES, True)} FROM coded_travelers GROUP BY {KEYS}")
def _(spark, sf):
    out = D.route_traveler_agg(view(spark, sf, "travelers"))
    return out.select(*D.ROUTE, *[n for n, _ in TOTALS], *[r6(n) for n, _ in RATES])


@query("segmented_rates", f"{with_views('travelers')} SELECT {KEYS}, {_list(NAT_RATES, True)} FROM coded_travelers GROUP BY {KEYS}")
def _(spark, sf):
    out = D.segmented_rates(view(spark, sf, "travelers"), "nationality", NAT, "alert_rate_")
    return out.select(*D.ROUTE, *[r6(n) for n, _ in NAT_RATES])


@query("segmented_document_rates", f"{with_views('travelers')} SELECT {KEYS}, {_list(DOC_RATES, True)} FROM coded_travelers GROUP BY {KEYS}")
def _(spark, sf):
    out = D.segmented_rates(view(spark, sf, "travelers"), "document_type2", DOC, "alert_rate_doc_")
    return out.select(*D.ROUTE, *[r6(n) for n, _ in DOC_RATES])


@query("category_shares", f"{with_views('travelers')} SELECT {KEYS}, {_list(NAT_SHARES + OUT_SHARES, True)} FROM coded_travelers GROUP BY {KEYS}")
def _(spark, sf):
    out = D.category_shares(view(spark, sf, "travelers"), NAT, OUT)
    return out.select(*D.ROUTE, *[r6(n) for n, _ in NAT_SHARES + OUT_SHARES])


@query("uncoded_rows", f"{with_views('alarms')} SELECT count(*) AS n_rows, count(*) FILTER (NOT ({CODED})) AS n_uncoded FROM alarms")
def _(spark, sf):
    return D.uncoded(view(spark, sf, "alarms"))


@query("route_master", f"{ROUTE_MASTER} {ROUTE_OUTPUT}")
def _(spark, sf):
    return show_routes(routes_of(spark, sf))


@query("route_master_discovered", f"{ROUTE_MASTER} SELECT route, data_coverage, CAST(tot_entries AS BIGINT) AS tot_entries, {R('alert_rate')} AS alert_rate FROM routes")
def _(spark, sf):
    """Category values are read from the data instead of being frozen."""
    out = D.build_route_master(view(spark, sf, "alarms"), view(spark, sf, "travelers"))
    return out.select("route", "data_coverage", n64("tot_entries"), r6("alert_rate"))


@query(
    "numeric_zero_fill",
    f"{ROUTE_MASTER} SELECT data_coverage, count(*) AS n, CAST(SUM(tot_a_f) AS BIGINT) AS tot_a_f, CAST(SUM(tot_entries) AS BIGINT) AS tot_entries, "
    "count(CASE WHEN alert_rate = 0 THEN 1 END) AS n_zero_rate FROM routes GROUP BY 1",
)
def _(spark, sf):
    return routes_of(spark, sf).groupBy("data_coverage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tot_a_f").alias("tot_a_f"), F.sum("tot_entries").alias("tot_entries"),
        F.count_if(F.col("alert_rate") == 0).alias("n_zero_rate"),
    )


@query(
    "country_top_airport",
    f"{with_views('alarms')} SELECT country, departure_airport_iata AS iata FROM (SELECT upper(departure_country) AS country, departure_airport_iata, "
    "row_number() OVER (PARTITION BY upper(departure_country) ORDER BY count(*) DESC, departure_airport_iata) AS rn FROM alarms WHERE departure_airport_iata IS NOT NULL GROUP BY 1, 2) WHERE rn = 1",
)
def _(spark, sf):
    return D.country_top_iata(view(spark, sf, "alarms"))


_FEATURE_ROWS = ", ".join(f"({i}, '{c}')" for i, c in enumerate(FEATURES, 1))


@query(
    "selected_features",
    f"{ROUTE_MASTER} SELECT CAST(position AS BIGINT) AS position, feature, n_routes FROM (VALUES {_FEATURE_ROWS}) AS v(position, feature) "
    "CROSS JOIN (SELECT count(*) AS n_routes FROM routes)",
)
def _(spark, sf):
    routes = routes_of(spark, sf)
    n = routes.agg(F.count(F.lit(1)).alias("n_routes"))
    return X.feature_list(spark, routes.columns).withColumn("n_routes", n.scalar())


@query("log_features", f"{MATRIX} SELECT route, {', '.join(f'{R(f'l{i}')} AS \"{c}\"' for i, c in enumerate(FEATURES))} FROM logs")
def _(spark, sf):
    out = X.log1p_features(routes_of(spark, sf), FEATURES, keep=["route"])
    return out.select("route", *[r6(q(c), c) for c in FEATURES])


@query("scaled_features", f"{MATRIX} SELECT route, {', '.join(f'{R(f'f{i}')} AS \"{c}\"' for i, c in enumerate(FEATURES))} FROM matrix")
def _(spark, sf):
    logs = X.log1p_features(routes_of(spark, sf), FEATURES, keep=["route"])
    out = X.standard_scale(logs, FEATURES, keep=["route"])
    return out.select("route", *[r6(q(c), c) for c in FEATURES])


_CELLS = " UNION ALL ".join(f"SELECT f{i} AS x FROM matrix" for i in range(len(FEATURES)))


@query("scaler_check", f"{MATRIX} SELECT count(*) AS n_cells, {R('avg(x)')} AS mean, {R('stddev_pop(x)')} AS std FROM ({_CELLS})")
def _(spark, sf):
    logs = X.log1p_features(routes_of(spark, sf), FEATURES, keep=["route"])
    out = X.scaler_check(X.standard_scale(logs, FEATURES), FEATURES)
    return out.select(n64("n_cells"), r6("mean"), r6("std"))


@query(
    "minmax_scale",
    f"{ROUTE_MASTER}, s AS (SELECT min(tot_entries) AS lo, max(tot_entries) AS hi FROM routes) "
    f"SELECT route, {R('CAST(tot_entries - lo AS DOUBLE) / (hi - lo)')} AS scaled FROM routes CROSS JOIN s",
)
def _(spark, sf):
    return X.minmax(routes_of(spark, sf), "tot_entries", "scaled").select("route", r6("scaled"))
