"""Daily panel features, panel detectors and business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.operators import changes as X
from waypost.operators import panel as P
from waypost.operators import ranking as G
from waypost.operators import reports as H
from waypost.operators.detectors import flag_top, sigma_z
from waypost.plans.fixtures import PANEL_ORDER, PANEL_VALUES, table, view, with_views
from waypost.plans.registry import R, n64, query, r6
from waypost.plans.runs import run_panel
from waypost.session import materialize

ID = "departure_date, departure_airport_iata, arrival_airport_iata, nationality, control_outcome, document_type2, zone"
ID_COLS = ID.split(", ")
VECTOR = P.vector_columns(PANEL_VALUES)
COUNTS = ", ".join(f"count(CASE WHEN {c} = '{v}' THEN 1 END) AS {name}" for name, (c, v) in VECTOR.items())
VECTOR_SQL = f"SELECT departure_date, departure_airport_iata, {COUNTS}, count(*) AS total_alarms_day FROM alarms GROUP BY 1, 2"
FILLED = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in [*VECTOR, "total_alarms_day"])
BASE = f"""{with_views("travelers", "alarms")}, vec AS ({VECTOR_SQL}),
master AS (SELECT t.*, {FILLED} FROM travelers t LEFT JOIN vec USING (departure_date, departure_airport_iata)),
rated AS (SELECT *, CASE WHEN entries > 0 THEN CAST(total_alarms_day AS DOUBLE) / entries ELSE 0.0 END AS alarm_rate,
                 CASE WHEN entries > 0 THEN CAST(investigated AS DOUBLE) / entries ELSE 0.0 END AS investigation_rate FROM master)"""
ORDERED = "PARTITION BY departure_airport_iata ORDER BY departure_date, arrival_airport_iata, nationality, control_outcome, document_type2, zone"
PANEL = f"""{BASE}, based AS (SELECT *, avg(alarm_rate) OVER (PARTITION BY departure_airport_iata) AS airport_historical_avg_rate,
       avg(entries) OVER (PARTITION BY departure_airport_iata) AS airport_historical_avg_entries FROM rated),
panel AS (SELECT *, isodow(departure_date) - 1 AS day_of_week, CAST(isodow(departure_date) >= 6 AS INT) AS is_weekend, month(departure_date) AS month,
       alarm_rate - airport_historical_avg_rate AS rate_deviation,
       COALESCE(lag(alarm_rate) OVER ({ORDERED}), airport_historical_avg_rate) AS alarm_rate_yesterday,
       COALESCE(avg(alarm_rate) OVER ({ORDERED} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), airport_historical_avg_rate) AS rolling_7d_avg_rate,
       avg(alarm_rate) OVER ({ORDERED} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_inclusive,
       CASE WHEN airport_historical_avg_entries > 0 THEN entries / airport_historical_avg_entries ELSE 1.0 END AS traffic_multiplier,
       COALESCE(CAST(zone AS DOUBLE), 0.0) AS zone_risk_weight FROM based)"""


def _master(spark: SparkSession, sf: str) -> DataFrame:
    return P.daily_master(view(spark, sf, "travelers"), view(spark, sf, "alarms"), PANEL_VALUES)


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    return P.panel_rates(_master(spark, sf))


def _based(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(P.baseline_deviation(_rated(spark, sf)))


def panel_of(spark: SparkSession, sf: str) -> DataFrame:
    return P.engineer_features(view(spark, sf, "travelers"), view(spark, sf, "alarms"), PANEL_VALUES, PANEL_ORDER)


@query("daily_alarm_vector", f"{with_views('alarms')} {VECTOR_SQL}")
def _(spark, sf):
    return P.daily_alarm_vector(view(spark, sf, "alarms"), PANEL_VALUES)


@query("daily_alarm_totals", f"{with_views('alarms')} SELECT departure_date, departure_airport_iata, count(*) AS total_alarms_day FROM alarms GROUP BY 1, 2")
def _(spark, sf):
    return P.daily_alarm_vector(view(spark, sf, "alarms"), {}).select("departure_date", "departure_airport_iata", "total_alarms_day")


# A second panel: users instead of airports, event types instead of reasons.
_EVENTS = ["view", "signup", "error", "purchase", "click"]


@query(
    "daily_event_vector",
    "SELECT CAST(ts AS DATE) AS departure_date, CAST(user_id AS STRING) AS departure_airport_iata, "
    + ", ".join(f"count(CASE WHEN event_type = '{v}' THEN 1 END) AS event_type_{v}" for v in _EVENTS)
    + ", count(*) AS total_alarms_day FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    ev = table(spark, sf, "events").select(F.col("ts").alias("departure_date"), F.col("user_id").cast("string").alias("departure_airport_iata"), "event_type")
    return P.daily_alarm_vector(ev, {"event_type": _EVENTS})


@query("daily_master", f"{BASE} SELECT {ID}, {', '.join(VECTOR)}, total_alarms_day, entries FROM master")
def _(spark, sf):
    return _master(spark, sf).select(*ID_COLS, *VECTOR, "total_alarms_day", "entries")


@query("panel_rates", f"{BASE} SELECT {ID}, {R('alarm_rate')} AS alarm_rate, {R('investigation_rate')} AS investigation_rate FROM rated")
def _(spark, sf):
    return _rated(spark, sf).select(*ID_COLS, r6("alarm_rate"), r6("investigation_rate"))


@query("baseline_deviation", f"{PANEL} SELECT {ID}, {R('airport_historical_avg_rate')} AS airport_historical_avg_rate, {R('rate_deviation')} AS rate_deviation FROM panel")
def _(spark, sf):
    return _based(spark, sf).select(*ID_COLS, r6("airport_historical_avg_rate"), r6("rate_deviation"))


@query("lag_with_fallback", f"{PANEL} SELECT {ID}, {R('alarm_rate_yesterday')} AS alarm_rate_yesterday FROM panel")
def _(spark, sf):
    return P.lag_with_fallback(_based(spark, sf), PANEL_ORDER).select(*ID_COLS, r6("alarm_rate_yesterday"))


@query("rolling_past_mean", f"{PANEL} SELECT {ID}, {R('rolling_7d_avg_rate')} AS rolling_7d_avg_rate FROM panel")
def _(spark, sf):
    return P.rolling_past(_based(spark, sf), PANEL_ORDER).select(*ID_COLS, r6("rolling_7d_avg_rate"))


@query("rolling_inclusive_mean", f"{PANEL} SELECT {ID}, {R('rolling_inclusive')} AS rolling_inclusive FROM panel")
def _(spark, sf):
    return P.rolling_inclusive(_based(spark, sf), PANEL_ORDER).select(*ID_COLS, r6("rolling_inclusive"))


@query(
    "rolling_event_values",
    """SELECT event_id, {0} AS lag_1, {1} AS past_mean FROM events""".format(
        R("lag(value) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), lpad(CAST(event_id AS STRING), 12, '0'))"),
        R("avg(value) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), lpad(CAST(event_id AS STRING), 12, '0') ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"),
    ),
)
def _(spark, sf):
    """Many small ranges, so that users and days are cut between them."""
    ev = table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("departure_airport_iata"), F.to_date("ts").alias("departure_date"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("seq"), "value",
    )
    out = P.past_window_features(ev, "value", ["departure_date", "seq"], 7, parts=64)
    return out.select("event_id", r6("lag_1"), r6("past_mean"))


@query(
    "calendar_day_baselines",
    f"""{BASE}, daily AS (SELECT departure_airport_iata, departure_date, avg(alarm_rate) AS rate FROM rated GROUP BY 1, 2),
past AS (SELECT departure_airport_iata AS past_airport, departure_date AS past_date,
  avg(rate) OVER (PARTITION BY departure_airport_iata ORDER BY departure_date RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS d1,
  avg(rate) OVER (PARTITION BY departure_airport_iata ORDER BY departure_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS d7 FROM daily)
SELECT {ID}, {R('d1')} AS rate_previous_day, {R('d7')} AS rate_previous_days FROM rated JOIN past ON departure_airport_iata IS NOT DISTINCT FROM past_airport AND departure_date = past_date""",
)
def _(spark, sf):
    out = P.by_day_features(materialize(_rated(spark, sf)))
    return out.select(*ID_COLS, r6("rate_previous_day"), r6("rate_previous_days"))


@query("traffic_multiplier", f"{PANEL} SELECT {ID}, {R('airport_historical_avg_entries')} AS airport_historical_avg_entries, {R('traffic_multiplier')} AS traffic_multiplier FROM panel")
def _(spark, sf):
    out = P.traffic_multiplier(materialize(_master(spark, sf)))
    return out.select(*ID_COLS, r6("airport_historical_avg_entries"), r6("traffic_multiplier"))


@query("zone_weight", f"{with_views('travelers')} SELECT {ID}, COALESCE(CAST(zone AS DOUBLE), 0.0) AS zone_risk_weight FROM travelers")
def _(spark, sf):
    return P.zone_weight(view(spark, sf, "travelers")).select(*ID_COLS, "zone_risk_weight")


@query(
    "finite_or_zero",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_discount = 0 THEN 0.0 ELSE "
    + R("l_tax / l_discount")
    + " END AS ratio FROM lineitem",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "ratio", F.when(F.col("l_discount") == 0, F.when(F.col("l_tax") > 0, float("inf")).otherwise(float("nan"))).otherwise(F.col("l_tax") / F.col("l_discount"))
    )
    return P.finite_or_zero_columns(li, ["ratio"]).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", r6("ratio"))


_PANEL_OUT = ["alarm_rate", "investigation_rate", "rate_deviation", "alarm_rate_yesterday", "rolling_7d_avg_rate", "traffic_multiplier", "zone_risk_weight"]


@query("panel_features", f"{PANEL} SELECT {ID}, total_alarms_day, CAST(day_of_week AS INT) AS day_of_week, is_weekend, CAST(month AS INT) AS month, {', '.join(f'{R(c)} AS {c}' for c in _PANEL_OUT)} FROM panel")
def _(spark, sf):
    return panel_of(spark, sf).select(*ID_COLS, "total_alarms_day", "day_of_week", "is_weekend", "month", *[r6(c) for c in _PANEL_OUT])


@query(
    "baseline_summary",
    f"{PANEL} SELECT count(DISTINCT departure_airport_iata) AS n_airports, min(departure_date) AS first_day, max(departure_date) AS last_day, {R('avg(alarm_rate)')} AS avg_alarm_rate, "
    f"{R('max(alarm_rate)')} AS max_alarm_rate, {R('avg(traffic_multiplier)')} AS avg_traffic_multiplier, count(CASE WHEN rate_deviation > 0 THEN 1 END) AS n_above_baseline FROM panel",
)
def _(spark, sf):
    out = P.baseline_summary(panel_of(spark, sf))
    return out.select("n_airports", "first_day", "last_day", r6("avg_alarm_rate"), r6("max_alarm_rate"), r6("avg_traffic_multiplier"), "n_above_baseline")


@query("target_encoding", f"{BASE} SELECT {ID}, {R('avg(alarm_rate) OVER (PARTITION BY nationality)')} AS nationality_avg_rate FROM rated")
def _(spark, sf):
    return P.target_encode(materialize(_rated(spark, sf)), "nationality").select(*ID_COLS, r6("nationality_avg_rate"))


@query(
    "panel_three_sigma",
    f"{PANEL}, s AS (SELECT avg(rate_deviation) AS mu, stddev_samp(rate_deviation) AS sd FROM panel) "
    f"SELECT {ID}, {R('(rate_deviation - mu) / sd')} AS z_value, CAST(abs((rate_deviation - mu) / sd) >= 3 AS INT) AS z_flag FROM panel CROSS JOIN s",
)
def _(spark, sf):
    return sigma_z(_based(spark, sf), "rate_deviation").select(*ID_COLS, r6("z_value"), "z_flag")


RULED = f"""{PANEL}, lims AS (SELECT quantile_cont(total_alarms_day, 0.99) AS p99, quantile_cont(alarm_rate, 0.97) AS t FROM panel),
ruled AS (SELECT panel.*, CAST(alarm_rate > t AS INT) AS if_anomaly, CAST(alarm_rate >= 3 * greatest(airport_historical_avg_rate, 1e-6) AS INT) AS rule_rate_3x,
          CAST(traffic_multiplier >= 2 AS INT) AS rule_traffic_2x, CAST(total_alarms_day >= p99 AS INT) AS rule_volume_spike FROM panel CROSS JOIN lims),
fired AS (SELECT *, rule_rate_3x + rule_traffic_2x + rule_volume_spike AS rules_fired FROM ruled),
confirmed AS (SELECT *, CAST(if_anomaly = 1 AND rules_fired >= 1 AS INT) AS confirmed_anomaly FROM fired)"""


def _ruled(spark: SparkSession, sf: str) -> DataFrame:
    """Rules with a flag SQL can express: the top 3 % of the alarm rate."""
    return G.apply_business_rules(materialize(flag_top(materialize(panel_of(spark, sf)), "alarm_rate", 0.03, "if_anomaly")))


@query("rule_rate_3x", f"{RULED} SELECT {ID}, rule_rate_3x FROM ruled")
def _(spark, sf):
    return G.rule_rate_3x(_based(spark, sf)).select(*ID_COLS, "rule_rate_3x")


@query("rule_traffic_2x", f"{RULED} SELECT {ID}, rule_traffic_2x FROM ruled")
def _(spark, sf):
    return G.rule_traffic_2x(P.traffic_multiplier(materialize(_master(spark, sf)))).select(*ID_COLS, "rule_traffic_2x")


@query("rule_volume_spike", f"{RULED} SELECT {ID}, rule_volume_spike FROM ruled")
def _(spark, sf):
    return G.rule_volume_spike(materialize(_master(spark, sf))).select(*ID_COLS, "rule_volume_spike")


@query("business_rules", f"{RULED} SELECT {ID}, rules_fired, confirmed_anomaly FROM confirmed")
def _(spark, sf):
    return _ruled(spark, sf).select(*ID_COLS, "rules_fired", "confirmed_anomaly")


@query(
    "rule_breakdown",
    f"{RULED} SELECT CAST(SUM(rule_rate_3x) AS BIGINT) AS rate_3x, CAST(SUM(rule_traffic_2x) AS BIGINT) AS traffic_2x, CAST(SUM(rule_volume_spike) AS BIGINT) AS volume_spike, "
    "CAST(SUM(confirmed_anomaly) AS BIGINT) AS n_confirmed FROM confirmed",
)
def _(spark, sf):
    return G.rule_breakdown(_ruled(spark, sf))


@query("top_confirmed", f"{RULED} SELECT {ID}, {R('alarm_rate')} AS alarm_rate, rules_fired FROM confirmed WHERE confirmed_anomaly = 1 ORDER BY confirmed.alarm_rate DESC, {ID} LIMIT 15")
def _(spark, sf):
    return G.top_report(_ruled(spark, sf), "alarm_rate", ID_COLS).select(*ID_COLS, r6("alarm_rate"), "rules_fired")


@query(
    "context_lines",
    f"""{RULED} SELECT {ID}, printf('- %s | airport=%s | entries=%d | alarms=%d | alarm_rate=%.3f (baseline=%.3f) | traffic_multiplier=%.2fx | rules_fired=%d [%s] | severity=%.3f',
strftime(departure_date, '%Y-%m-%d'), departure_airport_iata, entries, total_alarms_day, alarm_rate, airport_historical_avg_rate, traffic_multiplier, rules_fired,
concat_ws(', ', CASE WHEN rule_rate_3x = 1 THEN 'rate>=3x' END, CASE WHEN rule_traffic_2x = 1 THEN 'traffic>=2x' END, CASE WHEN rule_volume_spike = 1 THEN 'volume_p99' END), alarm_rate) AS context_line
FROM confirmed WHERE confirmed_anomaly = 1 ORDER BY alarm_rate DESC, {ID} LIMIT 10""",
)
def _(spark, sf):
    return H.context_lines(_ruled(spark, sf), "alarm_rate", ID_COLS)


@query(
    "context_block",
    f"""{RULED}, lines AS (SELECT row_number() OVER (ORDER BY alarm_rate DESC, {ID}) + 5 AS line, printf('- %s | airport=%s | entries=%d | alarms=%d | alarm_rate=%.3f (baseline=%.3f) | traffic_multiplier=%.2fx | rules_fired=%d [%s] | severity=%.3f',
strftime(departure_date, '%Y-%m-%d'), departure_airport_iata, entries, total_alarms_day, alarm_rate, airport_historical_avg_rate, traffic_multiplier, rules_fired,
concat_ws(', ', CASE WHEN rule_rate_3x = 1 THEN 'rate>=3x' END, CASE WHEN rule_traffic_2x = 1 THEN 'traffic>=2x' END, CASE WHEN rule_volume_spike = 1 THEN 'volume_p99' END), alarm_rate) AS text
FROM confirmed WHERE confirmed_anomaly = 1 AND departure_airport_iata IS NOT NULL)
SELECT * FROM lines WHERE line < 16 UNION ALL SELECT 0, 'PERIMETER: {{}}' UNION ALL SELECT 1, 'USER QUERY: (none)'
UNION ALL SELECT 2, 'TOTAL OBSERVATIONS IN SCOPE: ' || count(*) FROM confirmed WHERE departure_airport_iata IS NOT NULL
UNION ALL SELECT 3, 'CONFIRMED ANOMALIES: ' || count(*) FROM confirmed WHERE confirmed_anomaly = 1 AND departure_airport_iata IS NOT NULL
UNION ALL SELECT 4, '' UNION ALL SELECT 5, 'TOP CONFIRMED ANOMALIES (most severe first):'""",
)
def _(spark, sf):
    return H.context_block(_ruled(spark, sf).dropna(subset=["departure_airport_iata"]), "alarm_rate", ID_COLS)


@query("context_block_empty", f"""{RULED} SELECT CAST(0 AS BIGINT) AS line, 'PERIMETER: {{}}' AS text UNION ALL SELECT 1, 'USER QUERY: from nowhere' UNION ALL SELECT 2, 'TOTAL OBSERVATIONS IN SCOPE: ' || count(*) FROM confirmed WHERE confirmed_anomaly = 0
UNION ALL SELECT 3, 'CONFIRMED ANOMALIES: 0' UNION ALL SELECT 4, '' UNION ALL SELECT 5, 'NO CONFIRMED ANOMALIES IN THIS PERIMETER.'""")
def _(spark, sf):
    return H.context_block(_ruled(spark, sf).filter("confirmed_anomaly = 0"), "alarm_rate", ID_COLS, request="from nowhere")


@query("panel_detectors")
def _(spark, sf):
    """Forest, LOF, three-sigma and rules on the whole panel."""
    out = run_panel(view(spark, sf, "travelers"), view(spark, sf, "alarms"), PANEL_VALUES, PANEL_ORDER)
    return out.select(
        *ID_COLS, "if_anomaly", r6("anomaly_severity_iso"), "lof_anomaly", r6("anomaly_severity_lof"), "z_anomaly", "rules_fired", "confirmed_anomaly"
    )


# ---- change of behaviour ------------------------------------------------------------------------

ROUTE = ["departure_airport_iata", "arrival_airport_iata"]
DAILY = f"""{BASE}, daily AS (SELECT departure_airport_iata, arrival_airport_iata, departure_date, CAST(sum(total_alarms_day) AS BIGINT) AS total_alarms_day, CAST(sum(entries) AS BIGINT) AS entries,
  CASE WHEN sum(entries) > 0 THEN CAST(sum(total_alarms_day) AS DOUBLE) / sum(entries) ELSE 0.0 END AS rate
  FROM rated GROUP BY 1, 2, 3)"""


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(X.daily_rates(_master(spark, sf), ROUTE, "departure_date", "total_alarms_day", "entries"))


def _rolled(days: int) -> str:
    w = f"OVER (PARTITION BY departure_airport_iata, arrival_airport_iata ORDER BY departure_date RANGE BETWEEN INTERVAL {days - 1} DAY PRECEDING AND CURRENT ROW)"
    return R(f"CASE WHEN sum(entries) {w} > 0 THEN CAST(sum(total_alarms_day) {w} AS DOUBLE) / sum(entries) {w} ELSE 0.0 END") + f" AS rate_{days}d"


@query("rolling_route_rates", f"{DAILY} SELECT departure_airport_iata, arrival_airport_iata, departure_date, {R('rate')} AS rate, {_rolled(7)}, {_rolled(28)} FROM daily")
def _(spark, sf):
    out = X.rolling_rates(_daily(spark, sf), ROUTE, "departure_date", "total_alarms_day", "entries")
    return out.select(*ROUTE, "departure_date", r6("rate"), r6("rate_7d"), r6("rate_28d"))


@query(
    "route_changes",
    f"""{DAILY.replace("WITH ", "WITH RECURSIVE ", 1)}, numbered AS (
  SELECT *, row_number() OVER w AS i, (rate - avg(rate) OVER p) / nullif(stddev_samp(rate) OVER p, 0) AS z FROM daily
  WINDOW p AS (PARTITION BY departure_airport_iata, arrival_airport_iata), w AS (PARTITION BY departure_airport_iata, arrival_airport_iata ORDER BY departure_date)),
chart AS (
  SELECT departure_airport_iata, arrival_airport_iata, departure_date, i, greatest(0.0, coalesce(z, 0) - 0.5) AS rise, greatest(0.0, -coalesce(z, 0) - 0.5) AS fall FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.departure_airport_iata, n.arrival_airport_iata, n.departure_date, n.i, greatest(0.0, c.rise + coalesce(z, 0) - 0.5), greatest(0.0, c.fall - coalesce(z, 0) - 0.5)
  FROM chart c JOIN numbered n ON n.i = c.i + 1 AND n.departure_airport_iata IS NOT DISTINCT FROM c.departure_airport_iata AND n.arrival_airport_iata IS NOT DISTINCT FROM c.arrival_airport_iata)
SELECT departure_airport_iata, arrival_airport_iata, departure_date, {R('rise')} AS rise, {R('fall')} AS fall, CAST(greatest(rise, fall) > 5 AS INT) AS change_flag FROM chart""",
)
def _(spark, sf):
    """Days on which a route's alarm rate has drifted away from its mean."""
    out = X.cusum(_daily(spark, sf), ROUTE, "departure_date")
    return out.select(*ROUTE, "departure_date", r6("rise"), r6("fall"), "change_flag")
