"""Profiles, distributions, correlations, outlier reports, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from waypost.functions import numbers as NU
from waypost.operators import profiling as C
from waypost.operators.ordering import sample_n
from waypost.operators.stats import quantiles
from waypost.plans.cleaning_queries import _COUNT, WD, _dirty
from waypost.plans.fixtures import table, view, with_views
from waypost.plans.registry import R, n64, query, r6
from waypost.plans.route_queries import ROUTE_MASTER, routes_of
from waypost.session import materialize, scratch_path

DIRTY_COLS = ["raw_count", "raw_gender", "raw_zone", "raw_text", "text_backup", "raw_risk"]
ORDER_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
WT = with_views("travelers")
SIGNALS = ["entries", "investigated", "alarms"]


def _travelers(spark, sf):
    return view(spark, sf, "travelers")


def _profile_sql(rel: str, cols, with_clause: str = "") -> str:
    parts = [
        f"SELECT '{c}' AS column_name, '{k}' AS dtype, count(*) - count({c}) AS missing, round(100.0 * (count(*) - count({c})) / count(*), 2) + 0.0 AS missing_pct, count(DISTINCT {c}) AS cardinality FROM {rel}"
        for c, k in cols
    ]
    return f"{with_clause} " + " UNION ALL ".join(parts)


@query("column_profile", _profile_sql("orders", ORDER_COLS))
def _(spark, sf):
    return C.profile(table(spark, sf, "orders"), [c for c, _ in ORDER_COLS])


@query("dirty_profile", _profile_sql("dirty", [(c, "string") for c in DIRTY_COLS], WD))
def _(spark, sf):
    return C.profile(_dirty(spark, sf), DIRTY_COLS)


_LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("sketch_within_error", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS cardinality FROM lineitem" for c in _LINE_COLS))
def _(spark, sf):
    """Sketched distinct counts; where one is within three standard errors (15 %) of the exact count, that is shown."""
    lines = table(spark, sf, "lineitem")
    sketch = C.profile(lines, exact=False).select("column_name", F.col("cardinality").alias("about"))
    exact = C.profile(lines).select("column_name", "cardinality").join(sketch, "column_name")
    near = F.abs(F.col("about") - F.col("cardinality")) <= 0.15 * F.col("cardinality")
    return exact.select("column_name", F.when(near, F.col("cardinality")).otherwise(F.col("about")).alias("cardinality"))


@query("column_profile_sketch")
def _(spark, sf):
    """Distinct counts by sketch: one pass, no row expansion."""
    return C.profile(table(spark, sf, "lineitem"), exact=False)


_LINE_KINDS = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


@query("profile_from_states", _profile_sql("lineitem", [(c, _LINE_KINDS.get(c, "double")) for c in _LINE_COLS]))
def _(spark, sf):
    """States of four parts, written one after the other, and the profile of them all; counts within five standard
    errors (5 %) of the exact ones are shown as these."""
    lines, path = table(spark, sf, "lineitem").select(*_LINE_COLS), scratch_path(spark, "states")
    for part in range(4):
        C.profile_states(lines.filter(F.col("l_orderkey") % 4 == part)).write.mode("append").parquet(path)
    united = C.profile_of_states(spark.read.parquet(path))
    exact = C.profile(lines).select("column_name", F.col("cardinality").alias("exact"))
    near = F.abs(F.col("cardinality") - F.col("exact")) <= 0.05 * F.col("exact")
    shown = united.join(exact, "column_name").withColumn("cardinality", F.when(near, F.col("exact")).otherwise(F.col("cardinality")))
    return shown.select("column_name", "dtype", "missing", "missing_pct", "cardinality")


_CARD = "SELECT column_name, cardinality, CASE WHEN cardinality > 400 THEN 'high' WHEN cardinality > 15 THEN 'warn' ELSE 'low' END AS bucket FROM ({}) t"


@query(
    "cardinality_buckets",
    _CARD.format(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS cardinality FROM documents" for c in ("text", "lang", "source"))),
)
def _(spark, sf):
    return C.cardinality_buckets(table(spark, sf, "documents"))


@query(
    "distinct_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, CASE WHEN count(DISTINCT {c}) BETWEEN 1 AND 100 THEN list_sort(list(DISTINCT {c}) FILTER ({c} IS NOT NULL)) END AS values_sorted FROM documents"
        for c in ("lang", "source", "text")
    ),
)
def _(spark, sf):
    return C.distinct_values(table(spark, sf, "documents"), ["lang", "source", "text"], limit=100)


@query(
    "missing_comparison",
    f"""{WD}, n AS (SELECT *, {_COUNT} AS cnt FROM dirty) SELECT 'RAW_COUNT' AS column_name, count(*) - count(raw_count) AS missing_before, count(*) - count(cnt) AS missing_after, 'kept' AS status FROM n
UNION ALL SELECT 'RAW_RISK', count(*) - count(raw_risk), NULL, 'dropped' FROM n
UNION ALL SELECT 'O_ORDERKEY', 0, 0, 'kept' UNION ALL SELECT 'FILLED', NULL, 0, 'new'""",
)
def _(spark, sf):
    before = _dirty(spark, sf).select("o_orderkey", "raw_count", "raw_risk")
    after = before.select("o_orderkey", NU.parse_count(F.col("raw_count")).alias("raw_count"), F.lit("x").alias("filled"))
    return C.missing_comparison(before, after)


@query(
    "missing_report",
    f"{WD}, m AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, round(100.0 * (count(*) - count({c})) / count(*), 2) + 0.0 AS missing_pct FROM dirty" for c in DIRTY_COLS)
    + ") SELECT * FROM m WHERE missing > 0",
)
def _(spark, sf):
    return C.missing_report(_dirty(spark, sf))


def _describe_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, count({c}) AS n, {R(f'avg({c})')} AS mean, {R(f'stddev_samp({c})')} AS std, {R(f'min({c})')} AS min, {R(f'quantile_cont({c}, 0.25)')} AS q25, "
        f"{R(f'quantile_cont({c}, 0.5)')} AS q50, {R(f'quantile_cont({c}, 0.75)')} AS q75, {R(f'max({c})')} AS max FROM travelers"
    )


@query("describe_signals", f"{WT} " + " UNION ALL ".join(_describe_sql(c) for c in SIGNALS))
def _(spark, sf):
    out = C.describe(materialize(_travelers(spark, sf)), SIGNALS)
    return out.select("column_name", "n", *[r6(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


QS = [0.5, 0.95, 0.99, 0.995, 0.999, 1.0]


@query("signal_quantiles", f"{WT} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS q, {R(f'quantile_cont({c}, {p})')} AS value FROM travelers" for c in SIGNALS for p in QS))
def _(spark, sf):
    return C.quantile_table(materialize(_travelers(spark, sf)), SIGNALS, QS).select("column_name", "q", r6("value"))


@query(
    "bucketed_quantiles",
    " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS column_name, {R(f'quantile_cont({c}, 0.5)')} AS q50, {R(f'quantile_cont({c}, 0.95)')} AS q95 FROM lineitem GROUP BY 1" for c in ("l_extendedprice", "l_quantity")),
)
def _(spark, sf):
    """Exact quantiles by bucket selection, the path for inputs too large to buffer."""
    wide = quantiles(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], [0.5, 0.95], ["l_returnflag"], written=True)
    parts = [wide.select("l_returnflag", F.lit(c).alias("column_name"), r6(F.col(c)[0], "q50"), r6(F.col(c)[1], "q95")) for c in ("l_extendedprice", "l_quantity")]
    return parts[0].unionByName(parts[1])


CAPS = [10, 20, 40, 60, 100, 200]


@query(
    "cap_retention",
    f"{WT} " + " UNION ALL ".join(
        f"SELECT CAST({c} AS BIGINT) AS cap, count(CASE WHEN entries BETWEEN 0 AND {c} AND investigated BETWEEN 0 AND {c} AND alarms BETWEEN 0 AND {c} THEN 1 END) AS kept, "
        f"round(100.0 * count(CASE WHEN entries BETWEEN 0 AND {c} AND investigated BETWEEN 0 AND {c} AND alarms BETWEEN 0 AND {c} THEN 1 END) / count(*), 2) + 0.0 AS kept_pct FROM travelers"
        for c in CAPS
    ),
)
def _(spark, sf):
    return C.cap_retention(_travelers(spark, sf), SIGNALS, CAPS)


@query(
    "value_histogram",
    f"WITH b AS (SELECT least(CAST(floor((least(greatest(l_extendedprice, 0), 1000) - 0.0) / 12.5) AS BIGINT), 79) AS bin FROM lineitem) SELECT bin, count(*) AS n, {R('bin * 12.5')} AS bin_lo FROM b GROUP BY bin",
)
def _(spark, sf):
    return C.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 80, 0, 1000).select("bin", "n", r6("bin_lo"))


_GRID = [i / 10 for i in range(0, 51, 5)]


@query(
    "kernel_density",
    f"{WT}, x AS (SELECT ln(1 + entries) AS v FROM travelers), h AS (SELECT count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h FROM x), g AS (SELECT unnest([{', '.join(map(str, _GRID))}]::DOUBLE[]) AS x) "
    f"SELECT g.x, {R('sum(exp(-0.5 * pow((g.x - v) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi()))')} AS density FROM g CROSS JOIN x CROSS JOIN h GROUP BY g.x",
)
def _(spark, sf):
    return C.kde(_travelers(spark, sf), "entries", _GRID, log=True).select("x", r6("density"))


@query("priority_frequencies", "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return C.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("top_sources", "SELECT source AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, sf):
    return C.value_counts(table(spark, sf, "documents"), "source", 10)


@query("monthly_records", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return C.monthly_counts(table(spark, sf, "orders"), "o_orderdate")


@query("entries_alarms_correlation", f"{WT} SELECT {R('corr(entries, alarms)')} AS r FROM travelers")
def _(spark, sf):
    return C.pearson(_travelers(spark, sf), "entries", "alarms").select(r6("r"))


CORR = ["entries", "investigated", "alarms", "zone"]
_PAIRS = [(CORR[i], CORR[j]) for i in range(len(CORR)) for j in range(i)]
_CORR_SQL = f"{WT} " + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(f'corr({a}, {b})')} AS r FROM travelers" for a, b in _PAIRS)


@query("correlation_matrix", _CORR_SQL)
def _(spark, sf):
    return C.corr_matrix(_travelers(spark, sf), CORR).select("col_a", "col_b", r6("r"))


@query("collinear_pairs", f"WITH m AS ({_CORR_SQL}) SELECT * FROM m WHERE abs(r) > 0.9")
def _(spark, sf):
    return C.collinear_pairs(_travelers(spark, sf), CORR).select("col_a", "col_b", r6("r"))


ZONES = [0, 1, 2, 3, 4]


@query("reason_zone_crosstab", f"{with_views('alarms')} SELECT alarm_reason, {', '.join(f'count(CASE WHEN zone = {z} THEN 1 END) AS z{z}' for z in ZONES)} FROM alarms GROUP BY 1")
def _(spark, sf):
    out = C.crosstab(view(spark, sf, "alarms"), "alarm_reason", "zone", ZONES)
    return out.select("alarm_reason", *[F.col(str(z)).alias(f"z{z}") for z in ZONES])


@query(
    "top_routes",
    f"{with_views('alarms')} SELECT departure_airport_iata, arrival_airport_iata, count(*) AS n, departure_airport_iata || ' -> ' || arrival_airport_iata AS route FROM coded_alarms GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15",
)
def _(spark, sf):
    return C.top_routes(view(spark, sf, "alarms"), "departure_airport_iata", "arrival_airport_iata")


_OUT = ["tot_entries", "tot_alarms", "alert_rate"]


def _fence_cte(c: str) -> str:
    return f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM routes)"


def _iqr_sql(c: str) -> str:
    out = f"count(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 END)"
    return (
        f"SELECT '{c}' AS column_name, {R('max(q1)')} AS q1, {R('max(q3)')} AS q3, {R('max(q3 - q1)')} AS iqr, {R('max(q1 - 1.5 * (q3 - q1))')} AS lower, {R('max(q3 + 1.5 * (q3 - q1))')} AS upper, "
        f"{out} AS outliers, round(100.0 * {out} / count({c}), 2) + 0.0 AS outlier_pct FROM routes CROSS JOIN {_fence_cte(c)}"
    )


@query("iqr_outliers", f"{ROUTE_MASTER} " + " UNION ALL ".join(_iqr_sql(c) for c in _OUT))
def _(spark, sf):
    out = C.iqr_report(materialize(routes_of(spark, sf)), _OUT)
    return out.select("column_name", *[r6(c) for c in ("q1", "q3", "iqr", "lower", "upper")], "outliers", "outlier_pct")


def _box_sql(c: str) -> str:
    inside = f"{c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return (
        f"SELECT '{c}' AS column_name, {R('max(q1)')} AS q1, {R('max(q2)')} AS median, {R('max(q3)')} AS q3, {R(f'min(CASE WHEN {inside} THEN {c} END)')} AS whisker_lo, "
        f"{R(f'max(CASE WHEN {inside} THEN {c} END)')} AS whisker_hi, count(CASE WHEN NOT ({inside}) THEN 1 END) AS n_fliers FROM routes CROSS JOIN {_fence_cte(c)}"
    )


@query("box_statistics", f"{ROUTE_MASTER} " + " UNION ALL ".join(_box_sql(c) for c in _OUT))
def _(spark, sf):
    out = C.box_stats(materialize(routes_of(spark, sf)), _OUT)
    return out.select("column_name", *[r6(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_fliers")


_MADS = f"""{ROUTE_MASTER}, med AS (SELECT median(ln(1 + alert_rate)) AS m FROM routes), mads AS (SELECT median(abs(ln(1 + alert_rate) - m)) AS d FROM routes CROSS JOIN med)"""


@query("modified_z", f"{_MADS} SELECT route, {R('0.6745 * (ln(1 + alert_rate) - m) / d')} AS mod_z, CAST(abs(0.6745 * (ln(1 + alert_rate) - m) / d) > 3.5 AS INT) AS mad_flag FROM routes CROSS JOIN med CROSS JOIN mads")
def _(spark, sf):
    return C.mad_zscore(materialize(routes_of(spark, sf)), "alert_rate").select("route", r6("mod_z"), "mad_flag")


def _mad_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, {R(f'(SELECT median({c}) FROM routes)')} AS median_raw, {R('max(d)')} AS mad_log, count(CASE WHEN d > 0 AND abs(0.6745 * (ln(1 + {c}) - m) / d) > 3.5 THEN 1 END) AS n_flagged, "
        f"round(100.0 * count(CASE WHEN d > 0 AND abs(0.6745 * (ln(1 + {c}) - m) / d) > 3.5 THEN 1 END) / count(*), 2) + 0.0 AS flagged_pct FROM routes "
        f"CROSS JOIN (SELECT median(ln(1 + {c})) AS m FROM routes) CROSS JOIN (SELECT median(abs(ln(1 + {c}) - (SELECT median(ln(1 + {c})) FROM routes))) AS d FROM routes)"
    )


@query("modified_z_summary", f"{ROUTE_MASTER} " + " UNION ALL ".join(_mad_sql(c) for c in ("alert_rate", "tot_alarms", "tot_investigated", "n_records")))
def _(spark, sf):
    out = C.mad_summary(materialize(routes_of(spark, sf)), ["alert_rate", "tot_alarms", "tot_investigated", "n_records"])
    return out.select("column_name", r6("median_raw"), r6("mad_log"), "n_flagged", "flagged_pct")


def _skew(expr: str, adjusted: bool) -> str:
    if adjusted:
        return f"skewness({expr})"
    return f"(skewness({expr}) * (count(*) - 2) / sqrt(CAST(count(*) AS DOUBLE) * (count(*) - 1)))"


def _skew_sql(adjusted: bool) -> str:
    parts = []
    for c in ("tot_entries", "tot_alarms", "alert_rate"):
        b, a = _skew(f"CAST({c} AS DOUBLE)", adjusted), _skew(f"ln(1 + {c})", adjusted)
        parts.append(f"SELECT '{c}' AS column_name, {R(b)} AS skew_before, {R(a)} AS skew_after, CAST(abs({b}) > 2 AS INT) AS high_before, CAST(abs({a}) > 2 AS INT) AS high_after FROM routes")
    return f"{ROUTE_MASTER} " + " UNION ALL ".join(parts)


def _skewed(spark, sf, adjusted):
    out = C.skew_report(routes_of(spark, sf), ["tot_entries", "tot_alarms", "alert_rate"], adjusted)
    return out.select("column_name", r6("skew_before"), r6("skew_after"), "high_before", "high_after")


@query("skewness_population", _skew_sql(False))
def _(spark, sf):
    return _skewed(spark, sf, False)


@query("skewness_adjusted", _skew_sql(True))
def _(spark, sf):
    return _skewed(spark, sf, True)


@query(
    "temporal_overlap",
    f"{with_views('travelers', 'alarms')}, l AS (SELECT min(departure_date) AS left_min, max(departure_date) AS left_max FROM alarms), r AS (SELECT min(departure_date) AS right_min, max(departure_date) AS right_max FROM travelers) "
    "SELECT *, CASE WHEN greatest(left_min, right_min) <= least(left_max, right_max) THEN greatest(left_min, right_min) END AS overlap_start, CASE WHEN greatest(left_min, right_min) <= least(left_max, right_max) THEN least(left_max, right_max) END AS overlap_end FROM l CROSS JOIN r",
)
def _(spark, sf):
    return C.temporal_overlap(view(spark, sf, "alarms"), view(spark, sf, "travelers"), "departure_date")


@query("seeded_sample", "SELECT o_orderkey FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 200")
def _(spark, sf):
    return sample_n(table(spark, sf, "orders"), ["o_orderkey"], 200).select("o_orderkey")


@query(
    "rate_by_zone",
    f"{ROUTE_MASTER} SELECT CAST(zone AS BIGINT) AS zone, count(*) AS n_routes, CAST(SUM(tot_investigated) AS BIGINT) AS tot_investigated, {R('avg(alert_rate)')} AS mean_alert_rate, {R('max(alert_rate)')} AS max_alert_rate FROM routes GROUP BY 1",
)
def _(spark, sf):
    out = C.rate_by_zone(routes_of(spark, sf))
    return out.select(n64("zone"), "n_routes", "tot_investigated", r6("mean_alert_rate"), r6("max_alert_rate"))


@query("coverage_counts", f"{ROUTE_MASTER} SELECT data_coverage, count(*) AS n FROM routes GROUP BY 1")
def _(spark, sf):
    return C.coverage_counts(routes_of(spark, sf))
