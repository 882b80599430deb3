"""Report payloads, Markdown bodies, audit rows and context lines."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waypost.operators.detectors import FLAGS, detector_counts
from waypost.operators.ranking import risk_distribution
from waypost.sources import vocab

# Report texts and the columns of the ranked table.
TITLE = "# Transit Anomaly Report"
INTERPRETATION = (
    "The ranked anomalies should be treated as an investigation queue, not as confirmed incidents. "
    "Higher-rank items combine high alert rate with meaningful volume and tight confidence intervals."
)
NO_ANOMALIES = "_No consensus anomalies._"
NO_REPORT = "The pipeline could not produce a report."
TOP_COLUMNS = [
    "rank", "route", "departure_country", "alert_rate", "ci95_str", "tot_investigated", "absolute_alarms",
    "anomaly_votes", "risk_level", "priority_score", "quality_note",
]


def top_rows(clean: DataFrame, by: Sequence[str] = (), n: int = 10) -> DataFrame:
    """The ``n`` best ranks per scope as one sorted array column ``top``."""
    cols = [c for c in TOP_COLUMNS if c in clean.columns]
    scope = list(by) or [F.lit(0)]
    best = clean.withColumn("_r", F.row_number().over(W.partitionBy(*scope).orderBy("rank"))).filter(F.col("_r") <= n)
    grouped = best.groupBy(*by) if by else best.groupBy()
    return grouped.agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("top"))


def report_payload(scored: DataFrame, clean: DataFrame, by: Sequence[str] = (), n: int = 10) -> DataFrame:
    """One row per scope: counts, level distribution and the ``n`` best rows."""
    counts = detector_counts(scored, by)
    levels = risk_distribution(clean, by).filter(F.col("n") > 0)
    grouped = levels.groupBy(*by) if by else levels.groupBy()
    # Largest level first; level order settles ties.
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "level_order", "risk_level", "n")))
    dist = grouped.agg(F.transform(listed, lambda s: F.struct(s["risk_level"].alias("risk_level"), s["n"].alias("n"))).alias("distribution"))
    total = (clean.groupBy(*by) if by else clean.groupBy()).agg(F.count(F.lit(1)).alias("n_consensus"))
    parts = [dist, total, top_rows(clean, by, n)]
    out = counts
    for part in parts:
        if by:
            out = out.join(part, list(by), "left")
        else:
            out = out.withColumns({c: part.select(c).scalar() for c in part.columns})
    return out.withColumn("n_consensus", F.coalesce("n_consensus", F.lit(0).cast("bigint"))).withColumnRenamed("n_rows", "n_routes")


def payload_json(payload: DataFrame) -> DataFrame:
    return payload.withColumn("payload", F.to_json(F.struct("*")))


def _number(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", col.cast("double")), r"0+$", ""), r"\.$", "")


def _cell(name: str, row: Column) -> Column:
    value = row[name]
    if name in ("alert_rate", "absolute_alarms", "priority_score", "tot_investigated"):
        return _number(value)
    return F.coalesce(value.cast("string"), F.lit(""))


def render_report(payload: DataFrame, perimeter: Column) -> DataFrame:
    """Adds ``report_md``: the Markdown body with fixed sections and texts.

    Rows whose ``status`` is not ``ready`` get the short body with the reason.
    """
    cols = [f.name for f in payload.schema["top"].dataType.elementType.fields]
    head = "| " + " | ".join(cols) + " |\n|" + "|".join("---" for _ in cols) + "|"
    line = lambda r: F.concat(F.lit("| "), F.concat_ws(" | ", *[_cell(c, r) for c in cols]), F.lit(" |"))
    table = F.when(
        F.coalesce(F.size("top"), F.lit(0)) > 0,
        F.concat(F.lit(head + "\n"), F.array_join(F.transform("top", line), "\n")),
    ).otherwise(NO_ANOMALIES)
    levels = F.transform("distribution", lambda s: F.concat(F.lit("'"), s["risk_level"], F.lit("': "), s["n"].cast("string")))
    dist = F.concat(F.lit("{"), F.coalesce(F.array_join(levels, ", "), F.lit("")), F.lit("}"))
    named = [(f, f"n_{f}") for f in FLAGS] + [("consensus_>=2", "consensus_2"), ("consensus_>=3", "consensus_3")]
    counts = F.concat(
        F.lit("{\n"),
        F.concat_ws(",\n", *[F.concat(F.lit(f'  "{label}": '), F.coalesce(F.col(c), F.lit(0)).cast("string")) for label, c in named]),
        F.lit("\n}"),
    )
    few = F.col("n_routes") < vocab.MIN_ROUTES
    counts = F.when(few, F.concat(F.lit('{\n  "too_few_routes": '), F.col("n_routes").cast("string"), F.lit("\n}"))).otherwise(counts)
    body = F.concat(
        F.lit(f"{TITLE}\n\n## Perimeter\n"), perimeter,
        F.lit("\n\n## Summary\n- Routes analysed: **"), F.coalesce(F.col("n_routes"), F.lit(0)).cast("string"),
        F.lit("**\n- Consensus anomalies (≥ 2/4 detectors): **"), F.coalesce(F.col("n_consensus"), F.lit(0)).cast("string"),
        F.lit("**\n- Risk distribution: "), dist,
        F.lit("\n\n## Detector counts\n"), counts,
        F.lit("\n\n## Top-10 ranked anomalies\n"), table,
        F.lit(f"\n\n## Interpretation\n{INTERPRETATION}\n"),
    )
    if "status" not in payload.columns:
        return payload.withColumn("report_md", body)
    short = F.concat(F.lit(f"{TITLE}\n\n## Status\n{NO_REPORT}\n\n**Reason**: "), F.coalesce("reason", F.lit("unknown")), F.lit("\n"))
    return payload.withColumn("report_md", F.when(F.col("status") == "ready", body).otherwise(short))


def perimeter_json(role: Column, iata: Column) -> Column:
    """``{"departure_iata": "IST"}``, or ``{}`` for the whole data."""
    return F.when(iata.isNull(), "{}").otherwise(
        F.concat(F.lit('{"'), role, F.lit('_iata": "'), iata, F.lit('"}'))
    )


# Texts of the context block.
CONTEXT_HEADS = ("PERIMETER: ", "USER QUERY: ", "TOTAL OBSERVATIONS IN SCOPE: ", "CONFIRMED ANOMALIES: ")
CONTEXT_TITLE, CONTEXT_NONE = "TOP CONFIRMED ANOMALIES (most severe first):", "NO CONFIRMED ANOMALIES IN THIS PERIMETER."


def context_block(df: DataFrame, severity: str, key: Sequence[str], k: int = 10, perimeter: str = "{}", request: str | None = None) -> DataFrame:
    """The whole context as numbered lines: what was asked, rows in scope, confirmed rows, then the lines or a note that there are none."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("confirmed_anomaly") == 1).alias("c"))
    head = F.array(
        *[F.concat(F.lit(h), v) for h, v in zip(CONTEXT_HEADS, (F.lit(perimeter), F.lit(request or "(none)"), F.col("n").cast("string"), F.col("c").cast("string")))],
        F.lit(""), F.when(F.col("c") == 0, CONTEXT_NONE).otherwise(CONTEXT_TITLE),
    )
    order = W.orderBy(F.desc(severity), *key)
    lines = context_lines(df, severity, key, k, severity_column=True).select((F.row_number().over(order) + 5).cast("bigint").alias("line"), F.col("context_line").alias("text"))
    return counted.select(F.posexplode(head).alias("line", "text")).withColumn("line", F.col("line").cast("bigint")).unionByName(lines)


def context_lines(df: DataFrame, severity: str, key: Sequence[str], k: int = 10, severity_column: bool = False) -> DataFrame:
    """One readable line per confirmed row, most severe first."""
    top = df.filter(F.col("confirmed_anomaly") == 1).orderBy(F.desc(severity), *key).limit(k)
    rules = F.array_compact(
        F.array(
            F.when(F.col("rule_rate_3x") == 1, "rate>=3x"),
            F.when(F.col("rule_traffic_2x") == 1, "traffic>=2x"),
            F.when(F.col("rule_volume_spike") == 1, "volume_p99"),
        )
    )
    line = F.concat_ws(
        " | ",
        F.concat(F.lit("- "), F.date_format("departure_date", "yyyy-MM-dd")),
        F.concat(F.lit("airport="), F.col("departure_airport_iata")),
        F.format_string("entries=%d", F.col("entries").cast("bigint")),
        F.format_string("alarms=%d", F.col("total_alarms_day").cast("bigint")),
        F.format_string("alarm_rate=%.3f (baseline=%.3f)", F.col("alarm_rate"), F.col("airport_historical_avg_rate")),
        F.format_string("traffic_multiplier=%.2fx", F.col("traffic_multiplier")),
        F.concat(F.lit("rules_fired="), F.col("rules_fired").cast("string"), F.lit(" ["), F.array_join(rules, ", "), F.lit("]")),
        F.format_string("severity=%.3f", F.col(severity)),
    )
    return top.select(*key, line.alias("context_line"), *([severity] if severity_column else []))


def audit(stage: str, df: DataFrame, **metrics: Column) -> DataFrame:
    """One audit row: stage, row count and named metrics as JSON."""
    named = [c.alias(n) for n, c in metrics.items()]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *named)
    detail = F.to_json(F.struct(*metrics)) if metrics else F.lit("{}")
    return counted.select(F.lit(stage).alias("stage"), "n_rows", detail.alias("metrics"))


def audit_observed(spark: SparkSession, stages: Mapping[str, Observation]) -> DataFrame:
    """The audit rows of stages that were watched while they were written; no job of its own."""
    rows = []
    for stage, seen in stages.items():
        metrics = dict(seen.get)
        rows.append((stage, metrics.pop("n_rows"), json.dumps({k: v for k, v in metrics.items() if v is not None}, separators=(",", ":"), default=str)))
    return spark.createDataFrame(rows, "stage string, n_rows bigint, metrics string")


def audit_log(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
