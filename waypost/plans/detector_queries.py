"""Neighbour search, density detectors, forest, votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.operators import detectors as DT
from waypost.operators import neighbors as N
from waypost.operators.projections import table_lists
from waypost.operators.features import feature_matrix
from waypost.operators.forest import isolation_scores
from waypost.operators.stats import quantiles
from waypost.plans.fixtures import CATEGORIES, table, view
from waypost.plans.registry import R, n64, query, r6
from waypost.plans.route_queries import FEATURES, MATRIX, ROUTE_MASTER, routes_of
from waypost.plans.runs import run_routes
from waypost.session import materialize
from waypost.sources.files import q

DIM = len(FEATURES)


def matrix_of(spark: SparkSession, sf: str) -> DataFrame:
    return feature_matrix(materialize(routes_of(spark, sf)), FEATURES, "route")


SQ = " + ".join(f"(a.f{i} - b.f{i}) * (a.f{i} - b.f{i})" for i in range(DIM))
PAIRS = f"""{MATRIX}, pairs AS (SELECT a.route AS p, b.route AS o, sqrt({SQ}) AS dist FROM matrix a JOIN matrix b ON a.route <> b.route),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY dist, o) AS place FROM pairs),
size AS (SELECT count(*) AS n FROM matrix)"""
LOF = f"""{PAIRS}, knn AS (SELECT p, o, dist FROM ranked CROSS JOIN size WHERE place <= greatest(2, least(20, n - 1))),
kd AS (SELECT p AS o, max(dist) AS kdist FROM knn GROUP BY p),
lrd AS (SELECT p, 1.0 / (avg(greatest(kdist, dist)) + 1e-10) AS lrd FROM knn JOIN kd USING (o) GROUP BY p),
lof AS (SELECT knn.p, avg(b.lrd) / max(a.lrd) AS lof_score FROM knn JOIN lrd a ON a.p = knn.p JOIN lrd b ON b.p = knn.o GROUP BY knn.p)"""
DBSCAN = f"""{PAIRS}, dparam AS (SELECT n, greatest(5, CAST(ceil(ln(n)) AS INT) + 1) AS m FROM size),
dkd AS (SELECT p, max(dist) AS kdist FROM ranked CROSS JOIN dparam WHERE place <= m - 1 GROUP BY p),
deps AS (SELECT quantile_cont(kdist, 0.95) AS eps FROM dkd),
core AS (SELECT p, kdist <= eps AS is_core FROM dkd CROSS JOIN deps),
near AS (SELECT pairs.p, min(dist) AS d, min(CASE WHEN dist <= eps THEN o END) AS label
         FROM pairs CROSS JOIN deps JOIN core c ON c.p = pairs.o AND c.is_core GROUP BY pairs.p),
noise AS (SELECT core.p, is_core, CASE WHEN NOT is_core AND (label IS NULL) THEN 1 ELSE 0 END AS dbscan_anomaly, d
          FROM core LEFT JOIN near USING (p))"""


@query("knn_routes", f"{PAIRS} SELECT p AS route, o AS neighbor, {R('dist')} AS dist, place FROM ranked WHERE place <= 8")
def _(spark, sf):
    out = N.knn(matrix_of(spark, sf), "route", "x", 8)
    return out.select("route", "neighbor", r6("dist"), "place")


_EMB_SQ = "list_sum(list_transform(list_zip(a.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
EMB_PAIRS = f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (SELECT a.vec_id AS p, b.vec_id AS o, sqrt({_EMB_SQ}) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY dist, o) AS place FROM pairs)"""


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


@query("knn_vectors", f"{EMB_PAIRS} SELECT p AS vec_id, o AS neighbor, {R('dist')} AS dist, place FROM ranked WHERE place <= 5")
def _(spark, sf):
    out = N.knn(_embeddings(spark, sf), "vec_id", "embedding", 5, written=True)
    return out.select("vec_id", "neighbor", r6("dist"), "place")


@query("knn_vectors_blocked", f"{EMB_PAIRS} SELECT p AS vec_id, o AS neighbor, {R('dist')} AS dist, place FROM ranked WHERE place <= 5")
def _(spark, sf):
    """Same search with small blocks, so that block routing is exercised."""
    out = N.knn(_embeddings(spark, sf), "vec_id", "embedding", 5, block_rows=128, written=True)
    return out.select("vec_id", "neighbor", r6("dist"), "place")


@query(
    "approximate_recall",
    "SELECT count(*) AS n_vectors, CAST(count(*) * 10 AS BIGINT) AS n_listed, CAST(0.9 AS DOUBLE) AS recall_at_least FROM embeddings",
)
def _(spark, sf):
    """Share of the true ten neighbours that random-projection tables find, in tenths up to 0.9."""
    rows = _embeddings(spark, sf)
    near = N.knn(rows, "vec_id", "embedding", 10, lists=table_lists())
    far = N.knn(rows, "vec_id", "embedding", 10).filter("place = 10").select("vec_id", F.col("dist").alias("far"))
    found = near.join(far, "vec_id").agg(
        F.count_distinct("vec_id").alias("n_vectors"), F.count(F.lit(1)).alias("n_listed"), F.avg((F.col("dist") <= F.col("far") * (1 + 1e-12)).cast("int")).alias("recall")
    )
    return found.select("n_vectors", "n_listed", F.least(F.floor(F.col("recall") * 10) / 10, F.lit(0.9)).alias("recall_at_least"))


# The second table holds every row twice under another key.
@query(
    "knn_with_copies",
    f"""WITH e AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
              UNION ALL SELECT CAST(vec_id + 1000000 AS BIGINT), CAST(embedding AS DOUBLE[]) FROM embeddings),
pairs AS (SELECT a.vec_id AS p, b.vec_id AS o, sqrt({_EMB_SQ}) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY dist, o) AS place FROM pairs)
SELECT p AS vec_id, o AS neighbor, {R('dist')} AS dist, place FROM ranked WHERE place <= 4""",
)
def _(spark, sf):
    e = _embeddings(spark, sf).select("vec_id", "embedding")
    both = e.unionByName(e.withColumn("vec_id", F.col("vec_id") + 1000000))
    return N.knn(both, "vec_id", "embedding", 4, written=True).select("vec_id", "neighbor", r6("dist"), "place")


@query(
    "within_radius",
    f"{PAIRS} SELECT m.route, 1 + count(p.o) AS n_within FROM matrix m LEFT JOIN (SELECT * FROM pairs WHERE dist <= 3.5) p ON p.p = m.route GROUP BY 1",
)
def _(spark, sf):
    return N.within_radius_count(matrix_of(spark, sf), "route", "x", 3.5)


@query("lof_scores", f"{LOF} SELECT p AS route, {R('lof_score')} AS lof_score FROM lof")
def _(spark, sf):
    return N.lof(matrix_of(spark, sf), "route", "x").select("route", r6("lof_score"))


@query("lof_flags", f"{LOF}, lim AS (SELECT quantile_cont(lof_score, 0.95) AS t FROM lof) SELECT p AS route, CAST(lof_score > t AS INT) AS lof_anomaly FROM lof CROSS JOIN lim")
def _(spark, sf):
    scores = materialize(N.lof(matrix_of(spark, sf), "route", "x"))
    return DT.flag_top(scores, "lof_score", 0.05, "lof_anomaly").select("route", "lof_anomaly")


@query("dbscan_parameters", f"{DBSCAN} SELECT n, CAST(m AS BIGINT) AS min_samples, {R('eps')} AS eps FROM dparam CROSS JOIN deps")
def _(spark, sf):
    nb = N.neighborhood(matrix_of(spark, sf), "route", "x")
    return N.dbscan_params(nb).select("n", n64("min_samples"), r6("eps"))


@query("dbscan_noise", f"{DBSCAN} SELECT p AS route, CAST(is_core AS INT) AS core, dbscan_anomaly FROM noise")
def _(spark, sf):
    return N.dbscan_noise(matrix_of(spark, sf), "route", "x")


@query("dbscan_severity", f"{DBSCAN} SELECT p AS route, {R('CASE WHEN is_core THEN 0 ELSE d END')} AS dbscan_severity FROM noise")
def _(spark, sf):
    return N.core_distance(matrix_of(spark, sf), "route", "x").select("route", r6("dbscan_severity"))


# Small eps graph (min_samples 4) so that several components appear; labels by
# repeated minimum over core links.
CLUSTERS = f"""{PAIRS.replace('WITH ', 'WITH RECURSIVE ', 1)},
dkd AS (SELECT p, max(dist) AS kdist FROM ranked WHERE place <= 3 GROUP BY p),
deps AS (SELECT quantile_cont(kdist, 0.95) AS eps FROM dkd),
core AS (SELECT p FROM dkd CROSS JOIN deps WHERE kdist <= eps),
links AS (SELECT pairs.p, pairs.o FROM pairs CROSS JOIN deps JOIN core a ON a.p = pairs.p JOIN core b ON b.p = pairs.o WHERE dist <= eps),
walk(p, label) AS (SELECT p, p FROM core UNION SELECT links.o, walk.label FROM walk JOIN links ON links.p = walk.p WHERE walk.label < links.o),
comp AS (SELECT p, min(label) AS cluster FROM walk GROUP BY p),
border AS (SELECT pairs.p, min(comp.cluster) AS cluster FROM pairs CROSS JOIN deps JOIN comp ON comp.p = pairs.o
           WHERE dist <= eps AND pairs.p NOT IN (SELECT p FROM core) GROUP BY pairs.p)
SELECT m.route, COALESCE(c.cluster, b.cluster) AS cluster FROM matrix m LEFT JOIN comp c ON c.p = m.route LEFT JOIN border b ON b.p = m.route"""


@query("dbscan_clusters", CLUSTERS)
def _(spark, sf):
    return N.dbscan_clusters(matrix_of(spark, sf), "route", "x", min_samples=4)


@query("dbscan_cluster_counts", f"WITH labelled AS ({CLUSTERS}) SELECT count(DISTINCT cluster) AS n_clusters, count(CASE WHEN cluster IS NULL THEN 1 END) AS n_noise FROM labelled")
def _(spark, sf):
    out = N.dbscan_clusters(matrix_of(spark, sf), "route", "x", min_samples=4)
    return out.agg(F.count_distinct("cluster").alias("n_clusters"), F.count_if(F.col("cluster").isNull()).alias("n_noise"))


def _z_sql(floor: str) -> str:
    med = ", ".join(f"median(f{i}) AS m{i}" for i in range(DIM))
    dev = ", ".join(f"abs(f{i} - m{i}) AS d{i}" for i in range(DIM))
    mad = ", ".join(f"median(d{i}) / 0.6744897501960817 AS s{i}" for i in range(DIM))
    if floor == "floor":
        z = ", ".join(f"d{i} / greatest(s{i}, 1e-9)" for i in range(DIM))
    else:
        z = ", ".join(f"CASE WHEN s{i} < 1e-9 THEN 0.0 ELSE d{i} / s{i} END" for i in range(DIM))
    return f"""{MATRIX}, med AS (SELECT {med} FROM matrix), dev AS (SELECT route, {dev} FROM matrix CROSS JOIN med),
mads AS (SELECT {mad} FROM dev), zed AS (SELECT route, greatest({z}) AS z_max FROM dev CROSS JOIN mads)"""


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    m = materialize(matrix_of(spark, sf))
    return m.select("route", *[F.col("x")[i].alias(f"f{i}") for i in range(DIM)])


# With a floored MAD z reaches 1e9, so its logarithm is compared.
@query("robust_z", f"{_z_sql('floor')} SELECT route, {R('ln(1 + z_max)')} AS ln_z_max, CAST(z_max > 3 AS INT) AS z_anomaly FROM zed")
def _(spark, sf):
    out = DT.robust_z(_wide(spark, sf), [f"f{i}" for i in range(DIM)], ["route"])
    return out.select("route", r6(F.log1p("z_max"), "ln_z_max"), "z_anomaly")


@query("robust_z_skip_zero_mad", f"{_z_sql('skip')} SELECT route, {R('z_max')} AS z_max, CAST(z_max > 3 AS INT) AS z_anomaly FROM zed")
def _(spark, sf):
    out = DT.robust_z(_wide(spark, sf), [f"f{i}" for i in range(DIM)], ["route"], mad_zero="skip")
    return out.select("route", r6("z_max"), "z_anomaly")


@query(
    "three_sigma",
    f"{ROUTE_MASTER}, s AS (SELECT avg(alert_rate) AS mu, stddev_samp(alert_rate) AS sd FROM routes) "
    f"SELECT route, {R('(alert_rate - mu) / sd')} AS z_value, CAST(abs((alert_rate - mu) / sd) >= 3 AS INT) AS z_flag FROM routes CROSS JOIN s",
)
def _(spark, sf):
    return DT.sigma_z(routes_of(spark, sf), "alert_rate").select("route", r6("z_value"), "z_flag")


@query(
    "flag_top_share",
    f"{ROUTE_MASTER}, lim AS (SELECT quantile_cont(alert_rate, 0.95) AS t FROM routes) SELECT route, CAST(alert_rate > t AS INT) AS flag, {R('alert_rate - t')} AS severity FROM routes CROSS JOIN lim",
)
def _(spark, sf):
    out = DT.flag_top(routes_of(spark, sf), "alert_rate", 0.05, "flag", severity="severity")
    return out.select("route", "flag", r6("severity"))


# Four flags that SQL can express, used wherever votes are needed as an input.
FLAGGED = f"""{ROUTE_MASTER}, lims AS (SELECT quantile_cont(alert_rate, 0.95) AS t1, quantile_cont(tot_alarms, 0.93) AS t2,
quantile_cont(investigation_rate, 0.97) AS t3, quantile_cont(tot_entries, 0.90) AS t4 FROM routes),
flagged AS (SELECT routes.*, CAST(alert_rate > t1 AS INT) AS if_anomaly, CAST(tot_alarms > t2 AS INT) AS lof_anomaly,
CAST(investigation_rate > t3 AS INT) AS dbscan_anomaly, CAST(tot_entries > t4 AS INT) AS z_anomaly FROM routes CROSS JOIN lims),
voted AS (SELECT *, if_anomaly + lof_anomaly + dbscan_anomaly + z_anomaly AS anomaly_votes FROM flagged),
scored AS (SELECT *, CAST(anomaly_votes >= 2 AS INT) AS anomaly_consensus FROM voted)"""


def flagged_routes(spark: SparkSession, sf: str) -> DataFrame:
    routes = materialize(routes_of(spark, sf))
    cols = {"alert_rate": (0.95, "if_anomaly"), "tot_alarms": (0.93, "lof_anomaly"), "investigation_rate": (0.97, "dbscan_anomaly"), "tot_entries": (0.90, "z_anomaly")}
    qs = [0.95, 0.93, 0.97, 0.90]
    limits = quantiles(routes, list(cols), qs).select(F.struct(*[F.col(q(c)).alias(c) for c in cols]).alias("s")).scalar()
    wide = routes.withColumn("_l", limits)
    return wide.withColumns(
        {flag: (F.col(c) > F.col("_l")[c][qs.index(p)]).cast("int") for c, (p, flag) in cols.items()}
    ).drop("_l")


def voted_routes(spark: SparkSession, sf: str) -> DataFrame:
    return DT.consensus(flagged_routes(spark, sf))


@query("consensus_votes", f"{FLAGGED} SELECT route, anomaly_votes, anomaly_consensus FROM scored")
def _(spark, sf):
    return voted_routes(spark, sf).select("route", "anomaly_votes", "anomaly_consensus")


@query("strict_consensus", f"{FLAGGED} SELECT route, {R('alert_rate')} AS alert_rate FROM flagged WHERE lof_anomaly = 1 AND z_anomaly = 1")
def _(spark, sf):
    out = DT.strict_consensus(flagged_routes(spark, sf), ["lof_anomaly", "z_anomaly"], "alert_rate", ["route"])
    return out.select("route", r6("alert_rate"))


@query("strict_consensus_top", f"{FLAGGED} SELECT route, {R('alert_rate')} AS alert_rate FROM flagged WHERE lof_anomaly = 1 AND z_anomaly = 1 ORDER BY flagged.alert_rate DESC, route LIMIT 5")
def _(spark, sf):
    out = DT.strict_consensus(flagged_routes(spark, sf), ["lof_anomaly", "z_anomaly"], "alert_rate", ["route"], 5)
    return out.select("route", r6("alert_rate"))


@query(
    "small_scope_guard",
    f"{FLAGGED}, sized AS (SELECT *, count(*) OVER (PARTITION BY data_coverage, zone) AS n FROM scored) SELECT route, CASE WHEN n < 10 THEN 0 ELSE if_anomaly END AS if_anomaly, "
    f"CASE WHEN n < 10 THEN 0 ELSE anomaly_votes END AS anomaly_votes, CASE WHEN n >= 10 THEN {R('alert_rate')} END AS alert_rate FROM sized",
)
def _(spark, sf):
    out = DT.guard_min_rows(voted_routes(spark, sf), 10, scores=["alert_rate"], by=["data_coverage", "zone"])
    return out.select("route", "if_anomaly", "anomaly_votes", r6("alert_rate"))


GRID = [0.03, 0.05, 0.07, 0.10]


def _sweep_sql() -> str:
    parts = []
    for c in GRID:
        t = f"(SELECT quantile_cont(alert_rate, {1 - c}) FROM routes)"
        u = f"(SELECT quantile_cont(alarm_intensity, {1 - c}) FROM routes)"
        a, b = f"CAST(alert_rate > {t} AS INT)", f"CAST(alarm_intensity > {u} AS INT)"
        v = f"({a} + {b} + dbscan_anomaly + z_anomaly)"
        parts.append(
            f"SELECT CAST({c} AS DOUBLE) AS contamination, CAST(SUM({a}) AS BIGINT) AS n_if, CAST(SUM({b}) AS BIGINT) AS n_lof, CAST(SUM({a} * {b}) AS BIGINT) AS n_if_and_lof, "
            f"CAST(SUM(dbscan_anomaly) AS BIGINT) AS n_dbscan, CAST(SUM(z_anomaly) AS BIGINT) AS n_z, count(CASE WHEN {v} >= 2 THEN 1 END) AS consensus_2, count(CASE WHEN {v} >= 3 THEN 1 END) AS consensus_3 FROM flagged"
        )
    return f"{FLAGGED} " + " UNION ALL ".join(parts)


@query("contamination_sweep", _sweep_sql())
def _(spark, sf):
    return DT.contamination_sweep(materialize(flagged_routes(spark, sf)), GRID, "alert_rate", "alarm_intensity")


@query("contamination_sweep_delta", f"WITH sw AS ({_sweep_sql()}) SELECT min(consensus_2) AS consensus_min, max(consensus_2) AS consensus_max, max(consensus_2) - min(consensus_2) AS delta FROM sw")
def _(spark, sf):
    return DT.sweep_delta(DT.contamination_sweep(materialize(flagged_routes(spark, sf)), GRID, "alert_rate", "alarm_intensity"))


def _agreement_sql() -> str:
    parts = []
    for i, a in enumerate(DT.FLAGS):
        for b in DT.FLAGS[i + 1 :]:
            both, either = f"count(CASE WHEN {a} = 1 AND {b} = 1 THEN 1 END)", f"count(CASE WHEN {a} = 1 OR {b} = 1 THEN 1 END)"
            parts.append(f"SELECT '{a}' AS detector_a, '{b}' AS detector_b, {both} AS n_both, {either} AS n_either, {R(f'COALESCE(CAST({both} AS DOUBLE) / NULLIF({either}, 0), 0)')} AS jaccard FROM flagged")
    return f"{FLAGGED} " + " UNION ALL ".join(parts)


@query("detector_agreement", _agreement_sql())
def _(spark, sf):
    out = DT.detector_agreement(flagged_routes(spark, sf))
    return out.select("detector_a", "detector_b", "n_both", "n_either", r6("jaccard"))


@query(
    "detector_counts",
    f"{FLAGGED} SELECT count(*) AS n_rows, {', '.join(f'CAST(SUM({f}) AS BIGINT) AS n_{f}' for f in DT.FLAGS)}, count(CASE WHEN anomaly_votes >= 2 THEN 1 END) AS consensus_2, "
    f"count(CASE WHEN anomaly_votes >= 3 THEN 1 END) AS consensus_3, {R('100.0 * SUM(dbscan_anomaly) / count(*)')} AS noise_pct FROM scored",
)
def _(spark, sf):
    out = DT.detector_counts(voted_routes(spark, sf))
    return out.withColumn("noise_pct", r6("noise_pct"))


@query("vote_distribution", f"{FLAGGED} SELECT anomaly_votes, count(*) AS n FROM scored GROUP BY 1")
def _(spark, sf):
    return DT.vote_distribution(voted_routes(spark, sf))


@query("isolation_forest")
def _(spark, sf):
    scores = materialize(isolation_scores(matrix_of(spark, sf), "route", "x"))
    out = DT.flag_top(scores, "if_raw", 0.05, "if_anomaly", severity="if_score")
    return out.select("route", r6("if_raw"), "if_anomaly", r6("if_score"))


@query("isolation_forest_vectors")
def _(spark, sf):
    return isolation_scores(_embeddings(spark, sf), "vec_id", "embedding").select("vec_id", r6("if_raw"))


def _far(spark: SparkSession, sf: str) -> DataFrame:
    """Routes, each a second time under another key, and one row far away from all."""
    rows = materialize(matrix_of(spark, sf))
    copies = rows.select(F.concat("route", F.lit("#")).alias("route"), "x")
    far = rows.orderBy("route").limit(1).select(F.lit("far").alias("route"), F.transform("x", lambda v: F.lit(1000.0)).alias("x"))
    return rows.unionByName(copies).unionByName(far)


@query(
    "forest_checks",
    f"{MATRIX} SELECT 2 * count(*) + 1 AS n_scored, CAST(0 AS BIGINT) AS n_out_of_range, CAST(0 AS BIGINT) AS n_copies_apart, CAST(1 AS INT) AS place_of_far_row, "
    "CAST(0 AS BIGINT) AS n_changed_by_partitions FROM matrix",
)
def _(spark, sf):
    """What holds for any forest: scores inside (0, 1), equal ones for equal rows, the highest for a far row, the same ones however rows are dealt."""
    rows = materialize(_far(spark, sf))
    scores = materialize(isolation_scores(rows, "route", "x"))
    again = isolation_scores(rows.repartition(13), "route", "x").withColumnRenamed("if_raw", "again")
    plain = scores.select(F.rtrim("route", F.lit("#")).alias("route"), "if_raw")
    apart = plain.groupBy("route").agg(F.min("if_raw").alias("a"), F.max("if_raw").alias("b")).filter("a <> b").agg(F.count(F.lit(1)).alias("n_copies_apart"))
    above = scores.filter(F.col("if_raw") >= scores.filter("route = 'far'").select("if_raw").scalar()).agg(F.count(F.lit(1)).cast("int").alias("place_of_far_row"))
    changed = scores.join(again, "route").filter("if_raw <> again").agg(F.count(F.lit(1)).alias("n_changed_by_partitions"))
    out = scores.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(~((F.col("if_raw") > 0) & (F.col("if_raw") < 1))).alias("n_out_of_range"))
    for one in (apart, above, changed):
        out = out.withColumn(one.columns[0], one.scalar())
    return out


@query(
    "pca_checks",
    f"{MATRIX} SELECT count(*) AS n_rows, CAST(0 AS DOUBLE) AS correlation, CAST(1 AS DOUBLE) AS first_is_eigenvector, CAST(1 AS DOUBLE) AS second_is_eigenvector, "
    "TRUE AS first_is_larger, TRUE AS no_column_varies_more FROM matrix",
)
def _(spark, sf):
    """Projections on eigenvectors of the covariance matrix: their covariances with the columns have the length of the variance."""
    rows = materialize(matrix_of(spark, sf))
    wide = materialize(DT.pca2(rows, "route", "x").join(rows, "route")).select("pc1", "pc2", *[F.col("x")[i].alias(f"x{i}") for i in range(DIM)])
    length = lambda pc: F.sqrt(sum((F.pow(F.covar_samp(f"x{i}", pc), 2) for i in range(DIM)), F.lit(0.0)))
    return wide.agg(
        F.count(F.lit(1)).alias("n_rows"), F.abs(F.round(F.corr("pc1", "pc2"), 6)).alias("correlation"),
        r6(length("pc1") / F.var_samp("pc1"), "first_is_eigenvector"), r6(length("pc2") / F.var_samp("pc2"), "second_is_eigenvector"),
        (F.var_samp("pc1") >= F.var_samp("pc2")).alias("first_is_larger"),
        (F.var_samp("pc1") * (1 + 1e-9) >= F.greatest(*[F.var_samp(f"x{i}") for i in range(DIM)])).alias("no_column_varies_more"),
    )


LOF_FLAGS = f"""{DBSCAN}{LOF[len(PAIRS):]}, lim AS (SELECT quantile_cont(lof_score, 0.95) AS t FROM lof),
lof_flagged AS (SELECT p, CAST(lof_score > t AS INT) AS lof_anomaly FROM lof CROSS JOIN lim)"""


@query(
    "ensemble_checks",
    f"{LOF_FLAGS} SELECT p AS route, lof_anomaly, dbscan_anomaly, TRUE AS votes_add_up, TRUE AS flags_follow_scores FROM lof_flagged JOIN noise USING (p)",
)
def _(spark, sf):
    """The ensemble's density flags as SQL finds them one by one, and its votes and other flags against its own scores."""
    scored = run_routes(view(spark, sf, "alarms"), view(spark, sf, "travelers"), CATEGORIES).scored
    votes = sum((F.col(f) for f in DT.FLAGS[1:]), F.col(DT.FLAGS[0]))
    return scored.select(
        "route", "lof_anomaly", "dbscan_anomaly",
        ((F.col("anomaly_votes") == votes) & (F.col("anomaly_consensus") == (votes >= 2).cast("int"))).alias("votes_add_up"),
        ((F.col("if_anomaly") == (F.col("if_score") > 0).cast("int")) & (F.col("z_anomaly") == (F.col("z_max") > 3).cast("int"))).alias("flags_follow_scores"),
    )


@query("detector_ensemble")
def _(spark, sf):
    run = run_routes(view(spark, sf, "alarms"), view(spark, sf, "travelers"), CATEGORIES)
    return run.scored.select(
        "route", *DT.FLAGS, "anomaly_votes", "anomaly_consensus", r6("if_score"), r6("lof_score"), n64("dbscan_min_samples"), r6("dbscan_eps")
    )


@query("pca_projection")
def _(spark, sf):
    return DT.pca2(materialize(matrix_of(spark, sf)), "route", "x").select("route", r6("pc1"), r6("pc2"))
