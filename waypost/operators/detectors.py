"""Detector ensemble, votes and the tables that describe them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.operators.features import feature_matrix, scaled_vectors, select_features, select_panel_features
from waypost.operators.forest import PANEL_TREES, TREES, isolation_scores
from waypost.operators.neighbors import (
    BLOCK_ROWS,
    Lists,
    density_points,
    lof_points,
    neighborhood,
    point_scores,
)
from waypost.operators.stats import attach, quantiles, rows_from
from waypost.session import materialize
from waypost.sources import vocab
from waypost.sources.files import q

# Normal-consistency factor of the MAD and its floor.
MAD_TO_SIGMA = 0.6744897501960817
MAD_FLOOR = 1e-9
FLAGS = ["if_anomaly", "lof_anomaly", "dbscan_anomaly", "z_anomaly"]


def flag_top(df: DataFrame, score: str, contamination: float, out: str, by: Sequence[str] = (), severity: str | None = None, written: bool = False) -> DataFrame:
    """Flag scores strictly above the (1 - contamination) percentile.

    ``severity`` names an optional column ``score - threshold``.
    """
    limit = quantiles(df, [score], [1.0 - contamination], by, written=written)
    limit = limit.select(*by, F.col(q(score))[0].alias("_limit"))
    wide = attach(df, limit, by)
    new = {out: (F.col(q(score)) > F.col("_limit")).cast("int")}
    if severity:
        new[severity] = F.col(q(score)) - F.col("_limit")
    return wide.withColumns(new).drop("_limit")


def robust_z(
    df: DataFrame, cols: Sequence[str], key: Sequence[str], t: float = 3.0, by: Sequence[str] = (),
    mad_zero: str = "floor",
) -> DataFrame:
    """Largest |x - median| / MAD over the columns, and the flag ``> t``.

    A zero MAD is floored, so any departure from the median is flagged;
    ``mad_zero="skip"`` leaves such columns out instead.
    """
    vectors = df.select(*by, *key, F.array(*[F.col(q(c)).cast("double") for c in cols]).alias("x"))
    return robust_z_vectors(materialize(vectors), "x", key, t, by, mad_zero)


def robust_z_vectors(
    df: DataFrame, vec: str, key: Sequence[str], t: float = 3.0, by: Sequence[str] = (), mad_zero: str = "floor",
) -> DataFrame:
    """``robust_z`` on an array column of a written table."""

    def middle(vectors: DataFrame, name: str) -> DataFrame:
        cells = vectors.select(*by, F.posexplode("x").alias("_axis", "_value"))
        per = quantiles(cells, ["_value"], [0.5], [*by, "_axis"], written=True).select(*by, "_axis", F.col("_value")[0].alias("m"))
        packed = F.transform(F.array_sort(F.collect_list(F.struct("_axis", "m"))), lambda s: s["m"]).alias(name)
        return per.groupBy(*by).agg(packed) if by else per.agg(packed)

    base = df.select(*by, *key, F.col(vec).alias("x"))
    centred = attach(base, middle(base, "_med"), by)
    dev = centred.select(*by, *key, F.zip_with("x", "_med", lambda v, m: F.abs(v - m)).alias("x"))

    def scaled(d: Column, mad: Column) -> Column:
        z = d / F.greatest(mad / MAD_TO_SIGMA, F.lit(MAD_FLOOR))
        return F.when(mad / MAD_TO_SIGMA < MAD_FLOOR, 0.0).otherwise(z) if mad_zero == "skip" else z

    z_max = F.array_max(F.zip_with("x", "_mad", scaled))
    wide = attach(dev, middle(dev, "_mad"), by).select(*by, *key, z_max.alias("z_max"))
    return wide.withColumn("z_anomaly", (F.col("z_max") > t).cast("int"))


def sigma_z(df: DataFrame, col: str, t: float = 3.0) -> DataFrame:
    """Three-sigma rule with the sample deviation; deviation 0 counts as 1."""
    x = F.col(q(col)).cast("double")
    wide = attach(df, df.agg(F.avg(x).alias("_mu"), F.stddev_samp(x).alias("_sd")))
    sd = F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0)
    z = (x - F.col("_mu")) / sd
    return wide.withColumns({"z_value": z, "z_flag": (F.abs(z) >= t).cast("int"), "z_severity": F.abs(z)}).drop("_mu", "_sd")


def consensus(df: DataFrame, flags: Sequence[str] = tuple(FLAGS), min_votes: int = 2) -> DataFrame:
    votes = sum((F.col(f) for f in flags[1:]), F.col(flags[0]))
    return df.withColumn("anomaly_votes", votes).withColumn("anomaly_consensus", (F.col("anomaly_votes") >= min_votes).cast("int"))


def strict_consensus(df: DataFrame, flags: Sequence[str], severity: str, key: Sequence[str], n: int | None = None) -> DataFrame:
    """Rows every listed detector flags, most severe first."""
    for f in flags:
        df = df.filter(F.col(f) == 1)
    ordered = df.orderBy(F.desc(severity), *key)
    return ordered if n is None else ordered.limit(n)


def guard_min_rows(df: DataFrame, n: int = vocab.MIN_ROUTES, flags: Sequence[str] = (*FLAGS, "anomaly_votes", "anomaly_consensus"), scores: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Zero flags and NULL scores where a scope has fewer than ``n`` rows."""
    counts = (df.groupBy(*by) if by else df.groupBy()).agg(F.count(F.lit(1)).alias("_n"))
    wide = attach(df, counts, by)
    few = F.col("_n") < n
    new = {f: F.when(few, 0).otherwise(F.col(f)).cast("int") for f in flags if f in df.columns}
    new |= {s: F.when(~few, F.col(s)) for s in scores if s in df.columns}
    return wide.withColumns(new).drop("_n")


def fit_detectors(
    routes: DataFrame, key: str = "route", cols: Sequence[str] | None = None, contamination: float = vocab.CONTAMINATION,
    seed: int = vocab.SEED, by: Sequence[str] = (), trees: int = TREES, min_rows: int = vocab.MIN_ROUTES,
    block_rows: int = BLOCK_ROWS, dbscan_info: bool = False, lists: Lists | None = None,
) -> DataFrame:
    """Four detectors and their votes for every route of every scope.

    ``lists`` is a method for the neighbour lists, exact by default.

    The scaled matrix is written once; LOF and DBSCAN share one neighbour
    search. ``routes`` keeps all its columns and gains the scores, by key.
    """
    by = list(by)
    chosen = list(cols) if cols is not None else select_features(routes.columns)
    matrix = materialize(feature_matrix(routes, chosen, key, by))

    forest = isolation_scores(matrix, key, "x", by, trees, seed)
    forest = flag_top(materialize(forest), "if_raw", contamination, "if_anomaly", by, severity="if_score", written=True).drop("if_raw")

    nb = neighborhood(matrix, key, "x", by, block_rows=block_rows, written=True, lists=lists)
    marks, params = density_points(nb)
    density = materialize(point_scores(nb, key, marks))
    density = flag_top(density, "lof_score", contamination, "lof_anomaly", by, written=True)

    z = robust_z_vectors(matrix, "x", [key], by=by)

    on = [*by, key]
    scored = routes.join(forest, on, "left").join(density, on, "left").join(z, on, "left")
    scored = scored.withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in FLAGS})
    scored = guard_min_rows(consensus(scored), min_rows, scores=["if_score", "lof_score", "z_max"], by=by)
    if dbscan_info:
        info = params.select(*by, F.col("min_samples").alias("dbscan_min_samples"), F.col("eps").alias("dbscan_eps"))
        scored = attach(scored, info, by)
    return scored


def fit_panel_detectors(
    panel: DataFrame, key: str, contamination: float = vocab.PANEL_CONTAMINATION, seed: int = vocab.SEED,
    min_rows: int = vocab.MIN_PANEL_ROWS, block_rows: int = BLOCK_ROWS, lists: Lists | None = None,
) -> DataFrame:
    """Forest, LOF and three-sigma rule on the daily panel.

    Below ``min_rows`` rows only the three-sigma rule runs. The forest sees raw
    features, LOF sees scaled ones. ``panel`` should be materialized and
    ``key`` unique.
    """
    cols = select_panel_features(panel.columns)
    z = sigma_z(panel, "rate_deviation").withColumnsRenamed(
        {"z_value": "z_rate_deviation", "z_flag": "z_anomaly", "z_severity": "anomaly_severity_z"}
    )
    if panel.count() < min_rows:
        return z.withColumns(
            {"if_anomaly": F.lit(0), "anomaly_severity_iso": F.lit(0.0), "lof_anomaly": F.lit(0), "anomaly_severity_lof": F.lit(0.0)}
        )
    raw = panel.select(key, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]).alias("x"))
    iso = flag_top(materialize(isolation_scores(raw, key, "x", trees=PANEL_TREES, seed=seed)), "if_raw", contamination, "if_anomaly", severity="anomaly_severity_iso", written=True)
    nb = neighborhood(scaled_vectors(panel, cols, key), key, "x", block_rows=block_rows, lists=lists)
    lof = flag_top(materialize(point_scores(nb, key, lof_points(nb))), "lof_score", contamination, "lof_anomaly", written=True)
    lof = lof.withColumnRenamed("lof_score", "anomaly_severity_lof")
    return z.join(iso.drop("if_raw"), key).join(lof, key)


def contamination_sweep(scored: DataFrame, grid: Sequence[float], if_score: str = "if_score", lof_score: str = "lof_score", written: bool = False) -> DataFrame:
    """Flags and consensus per contamination value.

    Scores do not depend on contamination, so they are thresholded at every
    grid value in one aggregate; nothing is fitted again.
    """
    qs = [1.0 - c for c in grid]
    limits = quantiles(scored, [if_score, lof_score], qs, written=written)
    limits = limits.select(F.col(q(if_score)).alias("_if_limits"), F.col(q(lof_score)).alias("_lof_limits"))
    wide = attach(scored.select(if_score, lof_score, "dbscan_anomaly", "z_anomaly"), limits)
    aggs: list[Column] = [F.sum("dbscan_anomaly").alias("_db"), F.sum("z_anomaly").alias("_z")]
    records = []
    for i, c in enumerate(grid):
        a = (F.col(if_score) > F.col("_if_limits")[i]).cast("int")
        b = (F.col(lof_score) > F.col("_lof_limits")[i]).cast("int")
        votes = a + b + F.col("dbscan_anomaly") + F.col("z_anomaly")
        aggs += [
            F.sum(a).alias(f"_a{i}"), F.sum(b).alias(f"_b{i}"), F.sum(a * b).alias(f"_ab{i}"),
            F.count_if(votes >= 2).alias(f"_v2{i}"), F.count_if(votes >= 3).alias(f"_v3{i}"),
        ]
        records.append(
            {
                "contamination": F.lit(float(c)), "n_if": F.col(f"_a{i}"), "n_lof": F.col(f"_b{i}"),
                "n_if_and_lof": F.col(f"_ab{i}"), "n_dbscan": F.col("_db"), "n_z": F.col("_z"),
                "consensus_2": F.col(f"_v2{i}"), "consensus_3": F.col(f"_v3{i}"),
            }
        )
    return rows_from(wide.agg(*aggs), records)


def sweep_delta(sweep: DataFrame) -> DataFrame:
    """Spread of the consensus size over the sweep."""
    return sweep.agg(
        F.min("consensus_2").alias("consensus_min"),
        F.max("consensus_2").alias("consensus_max"),
        (F.max("consensus_2") - F.min("consensus_2")).alias("delta"),
    )


def detector_agreement(df: DataFrame, flags: Sequence[str] = tuple(FLAGS)) -> DataFrame:
    """Overlap and Jaccard index of every pair of detectors, one pass."""
    aggs, records = [], []
    for i, (a, b) in enumerate(combinations(flags, 2)):
        x, y = F.col(a) == 1, F.col(b) == 1
        aggs += [F.count_if(x & y).alias(f"_i{i}"), F.count_if(x | y).alias(f"_u{i}")]
        share = F.when(F.col(f"_u{i}") > 0, F.col(f"_i{i}") / F.col(f"_u{i}")).otherwise(0.0)
        records.append({"detector_a": F.lit(a), "detector_b": F.lit(b), "n_both": F.col(f"_i{i}"), "n_either": F.col(f"_u{i}"), "jaccard": share})
    return rows_from(df.agg(*aggs), records)


def detector_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Flags per detector, consensus sizes and noise share."""
    table = (df.groupBy(*by) if by else df.groupBy()).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.coalesce(F.sum(f), F.lit(0)).alias(f"n_{f}") for f in FLAGS],
        F.count_if(F.col("anomaly_votes") >= 2).alias("consensus_2"),
        F.count_if(F.col("anomaly_votes") >= 3).alias("consensus_3"),
    )
    return table.withColumn("noise_pct", F.when(F.col("n_rows") > 0, 100.0 * F.col("n_dbscan_anomaly") / F.col("n_rows")))


def vote_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("anomaly_votes").agg(F.count(F.lit(1)).alias("n"))


def pca2(df: DataFrame, key: str, vec: str) -> DataFrame:
    """First two principal components of a centred matrix.

    The sign of each component is fixed so that its largest loading is positive.
    """
    rows = df.select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    model = PCA(k=2, inputCol="_v", outputCol="_pc").fit(rows)
    loadings = model.pc.toArray()
    signs = [1.0 if abs(col.max()) >= abs(col.min()) else -1.0 for col in loadings.T]
    pc = vector_to_array("_pc")
    return model.transform(rows).select(key, (pc[0] * signs[0]).alias("pc1"), (pc[1] * signs[1]).alias("pc2"))
