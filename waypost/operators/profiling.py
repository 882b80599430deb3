"""Profiles, distributions and cross-table coverage: the tables behind the plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.operators.stats import attach, melt, quantiles, rows_from
from waypost.sources.files import numeric_columns, q, text_columns

# Thresholds of the published profile.
WARN_CARDINALITY = 15
HIGH_CARDINALITY = 400
MAD_SCALE = 0.6745
LONG_TEXT = 64
#: Registers of a state's sketch, as a power of two: a standard error of about 1 %.
SKETCH_BITS = 13


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n): repeated values are combined before the exchange."""
    return melt(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Type, missing count and share, and number of distinct values per column.

    ``exact`` counts distinct values through one (column, value) aggregate, in
    which a digest stands for a long text.
    ``exact=False`` uses sketches in a single pass without expanding rows.
    """
    chosen = list(cols) if cols is not None else df.columns
    kinds = dict(df.dtypes)
    if exact:
        short = F.when(F.length("value") > LONG_TEXT, F.sha2("value", 256)).otherwise(F.col("value"))
        freq = melt(df, chosen).groupBy("column_name", short.alias("value")).agg(F.count(F.lit(1)).alias("n"))
        counted = freq.groupBy("column_name").agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
            F.count("value").alias("cardinality"),
        )
    else:
        aggs = []
        for i, c in enumerate(chosen):
            aggs += [F.count_if(F.col(q(c)).isNull()).alias(f"_m{i}"), F.approx_count_distinct(q(c)).alias(f"_d{i}")]
        counted = rows_from(
            df.agg(F.count(F.lit(1)).alias("_n"), *aggs),
            [
                {"column_name": F.lit(c), "n_rows": F.col("_n"), "missing": F.col(f"_m{i}"), "cardinality": F.col(f"_d{i}")}
                for i, c in enumerate(chosen)
            ],
        )
    dtype = F.create_map(*[F.lit(x) for c in chosen for x in (c, kinds[c])])
    return counted.select(
        "column_name",
        F.element_at(dtype, F.col("column_name")).alias("dtype"),
        "missing",
        F.round(F.col("missing") / F.col("n_rows") * 100, 2).alias("missing_pct"),
        "cardinality",
    )


def profile_states(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """What a profile needs of some rows: per column (and per value of ``by``) its type, rows, missing values and a
    mergeable sketch of its distinct values. One pass; write the states of each new partition beside the older ones."""
    chosen = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    kinds = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(chosen):
        aggs += [F.count_if(F.col(q(c)).isNull()).alias(f"_m{i}"), F.hll_sketch_agg(F.col(q(c)).cast("string"), SKETCH_BITS).alias(f"_s{i}")]
    grouped = (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)
    records = [
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("dtype"), F.col("_n").alias("n_rows"), F.col(f"_m{i}").alias("missing"), F.col(f"_s{i}").alias("sketch"))
        for i, c in enumerate(chosen)
    ]
    return grouped.select(*by, F.inline(F.array(*records)))


def profile_of_states(states: DataFrame) -> DataFrame:
    """The profile of all rows whose states are given; distinct values are estimated (about 1 % standard error)."""
    united = states.groupBy("column_name", "dtype").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("missing").alias("missing"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("cardinality")
    )
    return united.select("column_name", "dtype", "missing", F.round(F.col("missing") / F.col("n_rows") * 100, 2).alias("missing_pct"), "cardinality")


def cardinality_buckets(df: DataFrame, warn: int = WARN_CARDINALITY, high: int = HIGH_CARDINALITY, exact: bool = True) -> DataFrame:
    level = F.when(F.col("cardinality") > high, "high").when(F.col("cardinality") > warn, "warn").otherwise("low")
    return profile(df, text_columns(df), exact).select("column_name", "cardinality", level.alias("bucket"))


def distinct_values(df: DataFrame, cols: Sequence[str], limit: int = HIGH_CARDINALITY) -> DataFrame:
    """Number of distinct values per column, and the sorted values where there are at most ``limit`` (else null).

    Columns are counted first, long texts by their digests; only the values of
    the columns under the limit are exchanged, and no list is longer than it.
    """
    counts = profile(df, cols).select("column_name", F.col("cardinality").alias("n_distinct"))
    # One row per column.
    narrow = F.broadcast(counts.filter(F.col("n_distinct").between(1, limit)).select("column_name"))
    values = melt(df, cols).filter(F.col("value").isNotNull()).join(narrow, "column_name", "left_semi").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    lists = values.groupBy("column_name").agg(F.array_sort(F.collect_list("value")).alias("values_sorted"))
    return counts.join(lists, "column_name", "left")


def missing_counts(df: DataFrame, name: str) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(q(c)).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    return rows_from(counted, [{"column_name": F.lit(c), name: F.col(f"_m{i}")} for i, c in enumerate(df.columns)])


def missing_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing counts per column before and after, with dropped and new columns.

    Column names are compared without regard to case.
    """
    a = missing_counts(before.toDF(*[c.upper() for c in before.columns]), "missing_before")
    b = missing_counts(after.toDF(*[c.upper() for c in after.columns]), "missing_after")
    status = F.when(F.col("missing_before").isNull(), "new").when(F.col("missing_after").isNull(), "dropped").otherwise("kept")
    return a.join(b, "column_name", "full").withColumn("status", status)


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, most missing first."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(q(c)).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)]
    )
    table = rows_from(
        counted,
        [
            {
                "column_name": F.lit(c),
                "missing": F.col(f"_m{i}"),
                "missing_pct": F.round(F.col(f"_m{i}") / F.col("_n") * 100, 2),
            }
            for i, c in enumerate(df.columns)
        ],
    )
    return table.filter(F.col("missing") > 0).orderBy(F.desc("missing"), "column_name")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum."""
    chosen = list(cols) if cols is not None else numeric_columns(df)
    quart = quantiles(df, chosen, [0.25, 0.5, 0.75], written=True)
    aggs: list[Column] = []
    for i, c in enumerate(chosen):
        x = F.col(q(c)).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
        ]
    wide = attach(df.agg(*aggs), quart.select(*[F.col(q(c)).alias(f"_q{i}") for i, c in enumerate(chosen)]))
    return rows_from(
        wide,
        [
            {
                "column_name": F.lit(c), "n": F.col(f"n{i}"), "mean": F.col(f"mean{i}"), "std": F.col(f"std{i}"),
                "min": F.col(f"min{i}"), "q25": F.col(f"_q{i}")[0], "q50": F.col(f"_q{i}")[1],
                "q75": F.col(f"_q{i}")[2], "max": F.col(f"max{i}"),
            }
            for i, c in enumerate(chosen)
        ],
    )


def quantile_table(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(column, q, value), one row per column and quantile."""
    wide = quantiles(df, cols, qs, written=True)
    records = [
        {"column_name": F.lit(c), "q": F.lit(float(p)), "value": F.col(q(c))[j]} for c in cols for j, p in enumerate(qs)
    ]
    return rows_from(wide, records)


def cap_retention(df: DataFrame, cols: Sequence[str], caps: Sequence[float]) -> DataFrame:
    """Rows kept by each candidate cap, all caps in one pass."""

    def kept(cap: float) -> Column:
        cond = F.lit(True)
        for c in cols:
            cond = cond & F.coalesce(F.col(q(c)).between(0, cap), F.lit(False))
        return F.count_if(cond)

    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[kept(cap).alias(f"_k{i}") for i, cap in enumerate(caps)])
    return rows_from(
        counted,
        [
            {
                "cap": F.lit(int(cap)).cast("bigint"),
                "kept": F.col(f"_k{i}"),
                "kept_pct": F.round(F.col(f"_k{i}") / F.col("_n") * 100, 2),
            }
            for i, cap in enumerate(caps)
        ],
    )


def histogram(df: DataFrame, col: str, bins: int, lo: float, hi: float, clip: bool = True) -> DataFrame:
    """Equal-width counts on ``[lo, hi]``; the last bin is closed on both sides."""
    x = F.col(q(col)).cast("double")
    if clip:
        x = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))))
    width = (hi - lo) / bins
    bin_no = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("bigint")
    inside = df.filter(x.between(lo, hi)).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return inside.withColumn("bin_lo", F.lit(float(lo)) + F.col("bin") * width)


def kde(df: DataFrame, col: str, grid: Sequence[float], bandwidth: float | None = None, log: bool = False) -> DataFrame:
    """Gaussian density at the grid points; Scott bandwidth unless given.

    Each grid point is one conditional sum over the value counts, so the data
    is read once and never joined with the grid.
    """
    x = F.col(q(col)).cast("double")
    base = df.select((F.log1p(x) if log else x).alias("_x")).filter(F.col("_x").isNotNull())
    values = base.groupBy("_x").agg(F.count(F.lit(1)).alias("_w"))
    # Scott's rule in one dimension: sample deviation times n^(-1/5).
    total = values.agg(
        F.sum("_w").cast("double").alias("n"),
        F.sum(F.col("_w") * F.col("_x")).alias("s1"),
    )
    centred = attach(values, total.select("n", (F.col("s1") / F.col("n")).alias("mu")))
    spread = centred.agg(
        F.first("n").alias("_n"),
        F.sqrt(F.sum(F.col("_w") * (F.col("_x") - F.col("mu")) ** 2) / (F.first("n") - 1)).alias("_sd"),
    )
    h = F.lit(float(bandwidth)) if bandwidth else F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
    scaled = attach(values, spread.select("_n", h.alias("_h")))
    norm = F.max(F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))
    bells = [
        (F.sum(F.col("_w") * F.exp(-0.5 * ((F.lit(float(g)) - F.col("_x")) / F.col("_h")) ** 2)) / norm).alias(f"_g{i}")
        for i, g in enumerate(grid)
    ]
    return rows_from(
        scaled.agg(*bells), [{"x": F.lit(float(g)), "density": F.col(f"_g{i}")} for i, g in enumerate(grid)]
    )


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Non-null value frequencies, most frequent first, ties by value."""
    counts = df.filter(F.col(q(col)).isNotNull()).groupBy(F.col(q(col)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), "value")
    return ordered if n is None else ordered.limit(n)


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    month = F.to_date(F.date_trunc("month", F.col(ts)))
    return df.filter(F.col(ts).isNotNull()).groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"))


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(F.col(q(a)).cast("double"), F.col(q(b)).cast("double")).alias("r"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower triangle of pairwise-complete Pearson correlations, one pass."""
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    aggs = []
    for k, (a, b) in enumerate(pairs):
        x, y = F.col(q(a)).cast("double"), F.col(q(b)).cast("double")
        aggs.append(F.corr(F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)).alias(f"_r{k}"))
    return rows_from(
        df.agg(*aggs),
        [{"col_a": F.lit(a), "col_b": F.lit(b), "r": F.nanvl(F.col(f"_r{k}"), F.lit(None))} for k, (a, b) in enumerate(pairs)],
    )


def collinear_pairs(df: DataFrame, cols: Sequence[str], t: float = 0.9) -> DataFrame:
    return corr_matrix(df, cols).filter(F.abs("r") > t)


def crosstab(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    """Counts of ``a`` by ``b``; ``values`` are the wanted columns of ``b``."""
    table = df.filter(F.col(a).isNotNull()).groupBy(a).pivot(b, list(values)).count()
    return table.na.fill(0, [str(v) for v in values])


def top_routes(df: DataFrame, dep: str, arr: str, n: int = 15) -> DataFrame:
    counts = df.dropna(subset=[dep, arr]).groupBy(dep, arr).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), dep, arr).limit(n).withColumn("route", F.concat_ws(" -> ", dep, arr))


def _fences(df: DataFrame, cols: Sequence[str], k: float) -> tuple[DataFrame, list[str]]:
    quart = quantiles(df, cols, [0.25, 0.5, 0.75], written=True)
    names: list[str] = []
    parts: list[Column] = []
    for i, c in enumerate(cols):
        q1, q2, q3 = F.col(q(c))[0], F.col(q(c))[1], F.col(q(c))[2]
        iqr = q3 - q1
        for name, expr in (("q1", q1), ("q2", q2), ("q3", q3), ("lo", q1 - k * iqr), ("hi", q3 + k * iqr)):
            parts.append(expr.alias(f"_{name}{i}"))
            names.append(f"_{name}{i}")
    return attach(df.select(*[F.col(q(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]), quart.select(*parts)), names


def iqr_report(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, fences and outlier share per column."""
    wide, names = _fences(df, cols, k)
    aggs = [F.first(n).alias(n) for n in names]
    for i in range(len(cols)):
        x = F.col(f"_x{i}")
        aggs += [F.count(x).alias(f"_n{i}"), F.count_if((x < F.col(f"_lo{i}")) | (x > F.col(f"_hi{i}"))).alias(f"_out{i}")]
    return rows_from(
        wide.agg(*aggs),
        [
            {
                "column_name": F.lit(c), "q1": F.col(f"_q1{i}"), "q3": F.col(f"_q3{i}"),
                "iqr": F.col(f"_q3{i}") - F.col(f"_q1{i}"), "lower": F.col(f"_lo{i}"), "upper": F.col(f"_hi{i}"),
                "outliers": F.col(f"_out{i}"), "outlier_pct": F.round(F.col(f"_out{i}") / F.col(f"_n{i}") * 100, 2),
            }
            for i, c in enumerate(cols)
        ],
    )


def box_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (last value inside the fences) and flier count."""
    wide, names = _fences(df, cols, k)
    aggs = [F.first(n).alias(n) for n in names]
    for i in range(len(cols)):
        x = F.col(f"_x{i}")
        inside = x.between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
        aggs += [
            F.min(F.when(inside, x)).alias(f"_wlo{i}"), F.max(F.when(inside, x)).alias(f"_whi{i}"),
            F.count_if(~inside).alias(f"_fl{i}"),
        ]
    return rows_from(
        wide.agg(*aggs),
        [
            {
                "column_name": F.lit(c), "q1": F.col(f"_q1{i}"), "median": F.col(f"_q2{i}"), "q3": F.col(f"_q3{i}"),
                "whisker_lo": F.col(f"_wlo{i}"), "whisker_hi": F.col(f"_whi{i}"), "n_fliers": F.col(f"_fl{i}"),
            }
            for i, c in enumerate(cols)
        ],
    )


def mad_zscore(df: DataFrame, col: str, t: float = 3.5) -> DataFrame:
    """Modified Z on log1p values; a zero MAD flags nothing and leaves Z NULL."""
    wide = _with_mad(df, [col])
    z = F.when(F.col("_mad0") > 0, MAD_SCALE * (F.log1p(F.col(q(col)).cast("double")) - F.col("_med0")) / F.col("_mad0"))
    flag = F.coalesce(F.abs(z) > t, F.lit(False)).cast("int")
    return wide.withColumns({"mod_z": z, "mad_flag": flag}).drop("_med0", "_mad0")


def _with_mad(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    logs = df.select(*[F.log1p(F.col(q(c)).cast("double")).alias(f"_l{i}") for i, c in enumerate(cols)])
    names = [f"_l{i}" for i in range(len(cols))]
    med = quantiles(logs, names, [0.5], written=True).select(*[F.col(n)[0].alias(f"_med{i}") for i, n in enumerate(names)])
    dev = attach(logs, med).select(*[F.abs(F.col(f"_l{i}") - F.col(f"_med{i}")).alias(f"_d{i}") for i in range(len(cols))])
    mad = quantiles(dev, [f"_d{i}" for i in range(len(cols))], [0.5], written=True)
    mad = mad.select(*[F.col(f"_d{i}")[0].alias(f"_mad{i}") for i in range(len(cols))])
    return attach(attach(df, med), mad)


def mad_summary(df: DataFrame, cols: Sequence[str], t: float = 3.5) -> DataFrame:
    """Raw median, MAD of logs, flag count and share per column."""
    wide = _with_mad(df, cols)
    raw = quantiles(df, cols, [0.5], written=True).select(*[F.col(q(c))[0].alias(f"_raw{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        z = MAD_SCALE * (F.log1p(F.col(q(c)).cast("double")) - F.col(f"_med{i}")) / F.col(f"_mad{i}")
        hit = F.when(F.col(f"_mad{i}") > 0, F.abs(z) > t)
        aggs += [F.count_if(hit).alias(f"_f{i}"), F.first(f"_mad{i}").alias(f"_mad{i}")]
    return rows_from(
        attach(wide.agg(*aggs), raw),
        [
            {
                "column_name": F.lit(c), "median_raw": F.col(f"_raw{i}"), "mad_log": F.col(f"_mad{i}"),
                "n_flagged": F.col(f"_f{i}"), "flagged_pct": F.round(F.col(f"_f{i}") / F.col("_n") * 100, 2),
            }
            for i, c in enumerate(cols)
        ],
    )


def skew_report(df: DataFrame, cols: Sequence[str], adjusted: bool = False, high: float = 2.0) -> DataFrame:
    """Skewness before and after log1p; ``adjusted`` applies the sample factor."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.coalesce(F.col(q(c)).cast("double"), F.lit(0.0))
        aggs += [F.skewness(x).alias(f"_b{i}"), F.skewness(F.log1p(x)).alias(f"_a{i}")]
    wide = df.agg(F.count(F.lit(1)).cast("double").alias("_n"), *aggs)
    n = F.col("_n")
    factor = F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2)) if adjusted else F.lit(1.0)
    records = []
    for i, c in enumerate(cols):
        before = F.nanvl(F.col(f"_b{i}"), F.lit(None)) * factor
        after = F.nanvl(F.col(f"_a{i}"), F.lit(None)) * factor
        records.append(
            {
                "column_name": F.lit(c), "skew_before": before, "skew_after": after,
                "high_before": (F.abs(before) > high).cast("int"), "high_after": (F.abs(after) > high).cast("int"),
            }
        )
    return rows_from(wide, records)


def temporal_overlap(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Date range of both tables and their intersection (NULL when disjoint)."""
    left = a.agg(F.min(col).alias("left_min"), F.max(col).alias("left_max"))
    both = attach(left, b.agg(F.min(col).alias("right_min"), F.max(col).alias("right_max")))
    start, end = F.greatest("left_min", "right_min"), F.least("left_max", "right_max")
    return both.withColumns(
        {"overlap_start": F.when(start <= end, start), "overlap_end": F.when(start <= end, end)}
    )


def rate_by_zone(routes: DataFrame) -> DataFrame:
    """Routes, volume and rate per zone; routes without a zone are kept."""
    return routes.groupBy("zone").agg(
        F.count(F.lit(1)).alias("n_routes"),
        F.sum("tot_investigated").alias("tot_investigated"),
        F.avg("alert_rate").alias("mean_alert_rate"),
        F.max("alert_rate").alias("max_alert_rate"),
    )


def coverage_counts(routes: DataFrame) -> DataFrame:
    return routes.groupBy("data_coverage").agg(F.count(F.lit(1)).alias("n"))
