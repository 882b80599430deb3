"""Risk levels, confidence intervals, priority and the rule-based confirmation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.functions.scoring import ci_text, quality_note, risk_level, wilson_ci
from waypost.operators.joins import anti
from waypost.operators.ordering import global_rank
from waypost.operators.stats import attach, quantiles
from waypost.sources import vocab

# Weights of the priority score and the floor of the rate range.
RATE_WEIGHT, ALARM_WEIGHT = 0.60, 0.40
RANGE_FLOOR = 1e-9


def consensus_subset(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("anomaly_consensus") == 1)


def _group(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


def risk_thresholds(scored: DataFrame, by: Sequence[str] = (), written: bool = False) -> DataFrame:
    """Population median and subset percentiles of one scope, and the limits built from them."""
    flagged = F.col("anomaly_consensus") == 1
    cols = scored.select(
        *by,
        F.col("alert_rate").alias("rate"),
        F.when(flagged, F.col("alert_rate")).alias("sub_rate"),
        F.when(flagged, F.col("tot_investigated")).alias("sub_vol"),
    )
    found = quantiles(cols, ["rate", "sub_rate", "sub_vol"], [0.25, 0.33, 0.5, 0.66], by, written=written)
    table = found.select(
        *by,
        F.col("rate")[2].alias("pop_median"),
        F.col("sub_rate")[1].alias("p33"),
        F.col("sub_rate")[3].alias("p66"),
        F.col("sub_vol")[0].alias("vol_p25"),
    )
    return table.withColumns(
        {
            "t_high": F.greatest(3.0 * F.col("pop_median"), F.col("p66")),
            "t_med": F.greatest(1.5 * F.col("pop_median"), F.col("p33")),
            "t_vol": F.greatest(F.lit(2.0), F.col("vol_p25")),
        }
    )


def with_risk_level(df: DataFrame, thresholds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    limits = thresholds.select(*by, "pop_median", "t_high", "t_med", "t_vol")
    level = risk_level(
        F.col("alert_rate"), F.col("tot_investigated"), F.col("anomaly_votes"),
        F.col("pop_median"), F.col("t_high"), F.col("t_med"), F.col("t_vol"),
    )
    return attach(df, limits, by).withColumn("risk_level", level).drop("pop_median", "t_high", "t_med", "t_vol")


def with_confidence(df: DataFrame) -> DataFrame:
    """Quality note, Wilson interval, its text, width and tightness."""
    rate, volume = F.col("alert_rate"), F.col("tot_investigated")
    low, high = wilson_ci(rate, volume)
    return (
        df.withColumns({"quality_note": quality_note(rate, volume), "ci95_low": low, "ci95_high": high})
        .withColumns(
            {
                "ci95_str": ci_text(F.col("ci95_low"), F.col("ci95_high")),
                "ci_width": F.coalesce(F.col("ci95_high") - F.col("ci95_low"), F.lit(1.0)),
            }
        )
        .withColumn("ci_tightness", F.greatest(F.lit(0.0), 1.0 - F.col("ci_width")))
    )


def absolute_alarms(df: DataFrame) -> DataFrame:
    return df.withColumn("absolute_alarms", F.col("alert_rate") * F.col("tot_investigated")).withColumn(
        "absolute_alarms_log", F.log1p("absolute_alarms")
    )


def normalise_for_priority(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Consensus rows with ``rate_n`` (population range) and ``alarms_n`` (subset range).

    Both ranges come from one aggregate over the scored table.
    """
    logs = F.when(F.col("anomaly_consensus") == 1, F.log1p(F.col("alert_rate") * F.col("tot_investigated")))
    ranges = _group(scored, by).agg(
        F.min("alert_rate").alias("_rlo"), F.max("alert_rate").alias("_rhi"), F.min(logs).alias("_alo"), F.max(logs).alias("_ahi")
    )
    wide = attach(absolute_alarms(consensus_subset(scored)), ranges, by)
    span = F.col("_ahi") - F.col("_alo")
    rate_n = (F.col("alert_rate") - F.col("_rlo")) / F.greatest(F.col("_rhi") - F.col("_rlo"), F.lit(RANGE_FLOOR))
    alarms_n = F.when(span > 0, (F.col("absolute_alarms_log") - F.col("_alo")) / span).otherwise(0.0)
    return wide.withColumns({"rate_n": rate_n, "alarms_n": alarms_n}).drop("_rlo", "_rhi", "_alo", "_ahi")


def priority_score(df: DataFrame) -> DataFrame:
    raw = (RATE_WEIGHT * F.col("rate_n") + ALARM_WEIGHT * F.col("alarms_n")) * F.col("ci_tightness")
    return df.withColumn("priority_score", F.bround(raw, 4))


def rank(df: DataFrame, by: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Rank by priority; ties by departure and arrival code."""
    order = [F.desc("priority_score"), F.asc("departure_airport_iata"), F.asc("arrival_airport_iata")]
    return global_rank(df, order, "rank", by, rows)


def drop_disqualified(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("quality_note").isin(vocab.DISQUALIFYING))


def apply_post_processing(scored: DataFrame, by: Sequence[str] = (), drop: bool = True) -> tuple[DataFrame, DataFrame]:
    """Ranked consensus rows, and the same without disqualified ones (with them if ``drop`` is off).

    Ranks are given before disqualified rows leave, so the clean table has
    gaps. ``scored`` should be materialized: three passes read it.
    """
    n = scored.count()
    prepared = normalise_for_priority(scored, by)
    levelled = with_risk_level(with_confidence(prepared), risk_thresholds(scored, by, written=True), by)
    post = rank(priority_score(levelled), by, rows=n)
    return post, drop_disqualified(post) if drop else post


def risk_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per level in fixed order, zeros included."""
    counts = [F.count_if(F.col("risk_level") == level).alias(level) for level in vocab.RISK_LEVELS]
    levels = F.array(
        *[F.struct(F.lit(i).alias("level_order"), F.lit(v).alias("risk_level"), F.col(v).alias("n")) for i, v in enumerate(vocab.RISK_LEVELS, 1)]
    )
    return _group(df, by).agg(*counts).select(*by, F.inline(levels))


def excluded(post: DataFrame, clean: DataFrame, key: Sequence[str] = ("route",)) -> DataFrame:
    """Ranked rows that the clean table dropped, with the reason."""
    return anti(post, clean, key)


def run_summary(scored: DataFrame, post: DataFrame, clean: DataFrame) -> DataFrame:
    """Counters of one run."""
    base = scored.agg(F.count(F.lit(1)).alias("n_routes"), F.count_if(F.col("anomaly_votes") >= 3).alias("n_votes_3"))
    ranked = post.agg(F.count(F.lit(1)).alias("n_consensus"))
    kept = clean.agg(
        F.count(F.lit(1)).alias("n_clean"),
        *[F.count_if(F.col("risk_level") == v).alias(f"n_{v.lower()}") for v in vocab.RISK_LEVELS],
    )
    return attach(attach(base, ranked), kept).withColumn("n_excluded", F.col("n_consensus") - F.col("n_clean"))


# ------------------------------------------------------------ panel rules


def rule_rate_3x(df: DataFrame) -> DataFrame:
    floor = F.greatest(F.col("airport_historical_avg_rate"), F.lit(1e-6))
    return df.withColumn("rule_rate_3x", (F.col("alarm_rate") >= 3 * floor).cast("int"))


def rule_traffic_2x(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_traffic_2x", (F.col("traffic_multiplier") >= 2).cast("int"))


def rule_volume_spike(df: DataFrame, q: float = 0.99) -> DataFrame:
    """Daily alarms at or above the global percentile.

    The percentile reads value counts: daily totals repeat on many rows.
    """
    counts = df.groupBy("total_alarms_day").agg(F.count(F.lit(1)).alias("_w"))
    limit = quantiles(counts, ["total_alarms_day"], [q], weight="_w").select(F.col("total_alarms_day")[0])
    spike = F.col("total_alarms_day") >= F.col("_p99")
    return df.withColumn("_p99", limit.scalar()).withColumn("rule_volume_spike", spike.cast("int")).drop("_p99")


def apply_business_rules(df: DataFrame) -> DataFrame:
    """Three rules, how many fired, and confirmation of forest flags."""
    ruled = rule_volume_spike(rule_traffic_2x(rule_rate_3x(df)))
    fired = F.col("rule_rate_3x") + F.col("rule_traffic_2x") + F.col("rule_volume_spike")
    confirmed = (F.col("if_anomaly") == 1) & (F.col("rules_fired") >= 1)
    return ruled.withColumn("rules_fired", fired).withColumn("confirmed_anomaly", confirmed.cast("int"))


def top_report(df: DataFrame, severity: str, key: Sequence[str], n: int = 15) -> DataFrame:
    """Most severe confirmed rows; each task keeps only its own ``n``."""
    return df.filter(F.col("confirmed_anomaly") == 1).orderBy(F.desc(severity), *key).limit(n)


def rule_breakdown(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("rule_rate_3x").alias("rate_3x"), F.sum("rule_traffic_2x").alias("traffic_2x"),
        F.sum("rule_volume_spike").alias("volume_spike"), F.sum("confirmed_anomaly").alias("n_confirmed"),
    )
