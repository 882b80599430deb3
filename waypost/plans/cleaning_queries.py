"""Cleaning projections over the dirty view and other text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from waypost.functions import numbers as NU
from waypost.functions import text as TX
from waypost.functions.dates import parse_dates
from waypost.operators import cleaning as B
from waypost.plans.fixtures import VIEWS, table, view, with_views
from waypost.plans.registry import R, query, r6
from waypost.session import scratch_path
from waypost.sources import dims as DM
from waypost.sources import vocab
from waypost.sources.files import (
    drop_columns,
    enforce_schema,
    json_records,
    normalise_headers,
    preview,
    rename_columns,
    scan_csv,
    schema_summary,
    select_numeric,
    select_text,
    write_csv,
    write_json,
    write_report,
)

WD = with_views("dirty")
TOKENS = ", ".join(f"'{t}'" for t in vocab.PLACEHOLDERS)
NUM = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def _num(expr: str) -> str:
    return f"(CASE WHEN regexp_matches({expr}, {NUM}) THEN TRY_CAST({expr} AS DOUBLE) END)"


def _dirty(spark, sf):
    return view(spark, sf, "dirty")


@query("renamed_headers", f"{WD} SELECT o_orderkey, raw_text AS ALARM_REASON, raw_risk AS RISK_FLAG, raw_zone AS ZONE FROM dirty")
def _(spark, sf):
    raw = _dirty(spark, sf).select("o_orderkey", F.col("raw_text").alias("MOTIVO_ALLARME"), F.col("raw_risk").alias("flag_rischio"), F.col("raw_zone").alias("ZONA"))
    return rename_columns(raw, vocab.COLUMN_NAMES)


@query("normalised_headers", 'SELECT n_nationkey AS "N_NATIONKEY", n_name AS "N_NAME", n_regionkey AS "N_REGIONKEY" FROM nation')
def _(spark, sf):
    raw = table(spark, sf, "nation")
    return normalise_headers(raw.toDF(*[f" {c} " for c in raw.columns]))


@query("json_records", """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS record FROM nation""")
def _(spark, sf):
    return json_records(table(spark, sf, "nation"))


_RISK_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in vocab.RISK.items())


@query("dimension_lookup", f"{WD} SELECT o_orderkey, raw_risk, v AS risk FROM dirty LEFT JOIN (VALUES {_RISK_ROWS}) AS d(k, v) ON raw_risk = k")
def _(spark, sf):
    d = DM.mapping_dim(spark, vocab.RISK, "raw_risk", "risk")
    return _dirty(spark, sf).select("o_orderkey", "raw_risk").join(d, "raw_risk", "left").select("o_orderkey", "raw_risk", "risk")


@query("dropped_columns", "SELECT r_regionkey FROM region")
def _(spark, sf):
    return drop_columns(table(spark, sf, "region"), ["r_name", "not_there"])


@query("enforced_schema", "SELECT n_name, n_nationkey, n_regionkey FROM nation")
def _(spark, sf):
    return enforce_schema(table(spark, sf, "nation"), ["n_name"])


@query(
    "schema_summary",
    "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns, d AS dtype, CAST(k AS BIGINT) AS n_of_dtype FROM lineitem, (VALUES ('double', 4), ('bigint', 3), ('int', 1), ('string', 2), ('timestamp_ntz', 1)) AS v(d, k) GROUP BY d, k",
)
def _(spark, sf):
    return schema_summary(table(spark, sf, "lineitem"))


@query("numeric_columns", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def _(spark, sf):
    return select_numeric(table(spark, sf, "supplier"))


@query("text_columns", "SELECT c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return select_text(table(spark, sf, "customer"))


@query("null_placeholders", f"{WD} SELECT o_orderkey, CASE WHEN lower(trim(raw_text)) IN ({TOKENS}) THEN NULL ELSE trim(raw_text) END AS cleaned FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", TX.null_placeholders(F.col("raw_text"), vocab.PLACEHOLDERS).alias("cleaned"))


@query("standardised_text", f"{WD} SELECT o_orderkey, upper(trim(raw_text)) AS raw_text, upper(trim(raw_gender)) AS raw_gender FROM dirty")
def _(spark, sf):
    return B.standardise_text(_dirty(spark, sf).select("o_orderkey", "raw_text", "raw_gender"))


# Title case of order priorities such as "4-NOT SPECIFIED": words split on blanks.
_TITLE = "list_aggregate(list_transform(string_split(regexp_replace(trim(raw_text), '\\s+', ' ', 'g'), ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')"


@query("title_text", f"{WD} SELECT o_orderkey, {_TITLE} AS titled FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", TX.title_text(F.col("raw_text")).alias("titled"))


_VARIANTS = ", ".join(f"'{t}'" for t in vocab.UNKNOWN_VARIANTS)
_JUNK = ", ".join(f"'{t}'" for t in vocab.JUNK_TOKENS)


@query("unified_unknown", f"{WD} SELECT o_orderkey, CASE WHEN upper(trim(raw_text)) IN ({_VARIANTS}) THEN 'N.D.' ELSE upper(trim(raw_text)) END AS raw_text FROM dirty")
def _(spark, sf):
    return B.unify_unknown(B.standardise_text(_dirty(spark, sf).select("o_orderkey", "raw_text")), ["raw_text"])


@query("junk_to_null", f"{WD} SELECT o_orderkey, CASE WHEN raw_text IN ({_JUNK}) THEN NULL ELSE raw_text END AS raw_text, CASE WHEN raw_gender IN ({_JUNK}) THEN NULL ELSE raw_gender END AS raw_gender FROM dirty")
def _(spark, sf):
    return B.junk_to_null(_dirty(spark, sf).select("o_orderkey", "raw_text", "raw_gender"), ["raw_text", "raw_gender"])


@query("document_text_cleaning", f"SELECT doc_id, CASE WHEN lower(trim(lang)) IN ({TOKENS}) THEN NULL ELSE upper(trim(lang)) END AS lang, length(regexp_replace(text, '\\s+', ' ', 'g')) AS n_clean FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.upper(TX.null_placeholders(F.col("lang"), vocab.PLACEHOLDERS)).alias("lang"),
        F.length(F.regexp_replace("text", r"\s+", " ")).cast("bigint").alias("n_clean"),
    )


def _case(col: str, values: dict[str, str], other: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + f" ELSE {other} END"


@query("recoded_gender", f"{WD} SELECT o_orderkey, {_case('upper(raw_gender)', vocab.GENDER, 'upper(raw_gender)')} AS gender FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", TX.recode(F.upper("raw_gender"), vocab.GENDER).alias("gender"))


@query("recoded_risk", f"{WD} SELECT o_orderkey, COALESCE({_case('raw_risk', vocab.RISK, 'raw_risk')}, 'LOW RISK') AS risk FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", TX.fill_placeholder(TX.recode(F.col("raw_risk"), vocab.RISK), vocab.RISK_DEFAULT).alias("risk"))


_STRICT = {"maschio": "M", "female": "F", "1": "M", "2": "F"}


@query("strict_mapping", f"{WD} SELECT o_orderkey, {_case('lower(trim(raw_gender))', _STRICT, 'NULL')} AS gender FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", TX.map_strict(F.lower(TX.strip(F.col("raw_gender"))), _STRICT).alias("gender"))


@query("filled_placeholder", f"{WD} SELECT o_orderkey, COALESCE(upper(trim(text_backup)), 'NO REASON PROVIDED') AS reason FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", TX.fill_placeholder(TX.upper_trim(F.col("text_backup")), vocab.NO_REASON).alias("reason"))


@query("constant_columns", f"{WD} SELECT o_orderkey, 'ITALY' AS arrival_country, 'ITA' AS arrival_country_code FROM dirty")
def _(spark, sf):
    return B.with_constants(_dirty(spark, sf).select("o_orderkey"), {"arrival_country": "ITALY", "arrival_country_code": "ITA"})


# Codes of the airport directory on the alarm view; every third city is missing.
_AL = f"{with_views('alarms', 'airports')}, raw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, departure_airport_iata, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'old city' END AS city FROM alarms)"


def _raw_city(spark, sf):
    a = view(spark, sf, "alarms").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "departure_airport_iata")
    return a.withColumn("city", F.when(F.col("l_orderkey") % 3 != 0, "old city"))


@query("airport_overwrite", f"{_AL} SELECT raw.* REPLACE (airports.city AS city), airports.airport FROM raw LEFT JOIN airports ON departure_airport_iata = iata")
def _(spark, sf):
    d = view(spark, sf, "airports").withColumnRenamed("city", "dim_city")
    return B.enrich_from_dim(_raw_city(spark, sf), "departure_airport_iata", d, "iata", {"city": "dim_city", "airport": "airport"})


@query("airport_backfill", f"{_AL} SELECT raw.* REPLACE (COALESCE(raw.city, airports.city) AS city) FROM raw LEFT JOIN airports ON departure_airport_iata = iata")
def _(spark, sf):
    d = view(spark, sf, "airports").withColumnRenamed("city", "dim_city")
    return B.enrich_from_dim(_raw_city(spark, sf), "departure_airport_iata", d, "iata", {"city": "dim_city"}, mode="fill")


@query(
    "country_iso3",
    "SELECT s_suppkey, CASE n_name WHEN 'NATION_5' THEN 'RKS' ELSE 'X' || lpad(CAST(n_regionkey AS STRING), 2, '0') END AS iso3 FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def _(spark, sf):
    nation = table(spark, sf, "nation")
    english = nation.select(F.col("n_name").alias("country"), F.concat(F.lit("EN "), "n_name").alias("english"))
    iso = nation.select(F.concat(F.lit("EN "), "n_name").alias("english"), F.concat(F.lit("X"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0")).alias("iso3"))
    s = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.lit(" "), "n_name").alias("country_name"))
    return B.country_iso3(s, "country_name", english, iso, "iso3", {"NATION_5": "RKS"}).select("s_suppkey", "iso3")


@query("coalesced_columns", f"{WD} SELECT o_orderkey, COALESCE(text_backup, raw_text) AS merged FROM dirty")
def _(spark, sf):
    return B.coalesce_columns(_dirty(spark, sf), "merged", ["text_backup", "raw_text"]).select("o_orderkey", "merged")


_CLASH = "raw_text IS NOT NULL AND text_backup IS NOT NULL AND upper(trim(raw_text)) <> upper(trim(text_backup))"


@query("resolved_pairs_keep", f"{WD} SELECT o_orderkey, COALESCE(raw_risk, text_backup) AS raw_risk FROM dirty")
def _(spark, sf):
    out, _ = B.resolve_pairs(_dirty(spark, sf).select("o_orderkey", "raw_risk", "text_backup"), [("raw_risk", "text_backup")])
    return out


@query(
    "resolved_pairs_stats",
    f"{WD} SELECT 'raw_text' AS kept, 'text_backup' AS dropped, count(CASE WHEN {_CLASH} THEN 1 END) AS n_conflicts, count(CASE WHEN raw_text IS NULL AND text_backup IS NOT NULL THEN 1 END) AS n_filled, "
    f"count(CASE WHEN text_backup IS NOT NULL AND (raw_text IS NULL OR ({_CLASH})) THEN 1 END) AS n_overwritten FROM dirty",
)
def _(spark, sf):
    _, stats = B.resolve_pairs(_dirty(spark, sf), [("raw_text", "text_backup")], prefer="other")
    return stats


@query("conflict_filter", f"{WD} SELECT o_orderkey FROM dirty WHERE {_CLASH}")
def _(spark, sf):
    return _dirty(spark, sf).filter(B.conflict(F.col("raw_text"), F.col("text_backup"))).select("o_orderkey")


@query("conflict_preview", f"{WD} SELECT raw_text, text_backup FROM dirty WHERE {_CLASH} ORDER BY o_orderkey LIMIT 3")
def _(spark, sf):
    return preview(_dirty(spark, sf), B.conflict(F.col("raw_text"), F.col("text_backup")), ["raw_text", "text_backup"], ["o_orderkey"], 3)


@query(
    "most_complete_column",
    f"{WD} SELECT column_name, n_present FROM (SELECT 'raw_risk' AS column_name, count(raw_risk) AS n_present FROM dirty UNION ALL SELECT 'raw_gender', count(raw_gender) FROM dirty UNION ALL SELECT 'text_backup', count(text_backup) FROM dirty) ORDER BY 2 DESC LIMIT 1",
)
def _(spark, sf):
    return B.most_complete(_dirty(spark, sf), ["raw_risk", "raw_gender", "text_backup"])


_COUNT = _num("regexp_replace(regexp_replace(raw_count, '(?i)pax', '', 'g'), '\\s+', '', 'g')")
_LOCALE = _num("regexp_replace(replace(raw_count, ',', '.'), '[^\\d.\\-]', '', 'g')")
_FLIGHTS = _num("regexp_replace(regexp_replace(trim(raw_flights), '\\s*voli\\s*$', ''), '^~+', '')")


@query("parsed_count", f"{WD} SELECT o_orderkey, {_COUNT} AS n FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", NU.parse_count(F.col("raw_count")).alias("n"))


@query("parsed_count_locale", f"{WD} SELECT o_orderkey, CASE WHEN {_LOCALE} BETWEEN 0 AND 1000 THEN {_LOCALE} END AS n FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", NU.parse_count_locale(F.col("raw_count")).alias("n"))


@query("parsed_flights", f"{WD} SELECT o_orderkey, CAST(round_even(COALESCE(CASE WHEN {_FLIGHTS} BETWEEN 0 AND 1000 THEN {_FLIGHTS} END, 0), 0) AS INT) AS n FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select("o_orderkey", NU.parse_bounded_count(F.col("raw_flights")).alias("n"))


@query("signal_range_filter", "SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity BETWEEN 0 AND 30 AND l_discount BETWEEN 0 AND 30")
def _(spark, sf):
    return B.filter_signal_range(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], 30).select("l_orderkey", "l_quantity", "l_discount")


@query("signal_cap_filter", f"{with_views('travelers')} SELECT departure_airport_iata, count(*) AS n, CAST(SUM(entries) AS BIGINT) AS entries FROM travelers WHERE entries BETWEEN 0 AND 40 AND investigated BETWEEN 0 AND 40 AND alarms BETWEEN 0 AND 40 GROUP BY 1")
def _(spark, sf):
    kept = B.filter_signal_range(view(spark, sf, "travelers"), ["entries", "investigated", "alarms"], 40)
    return kept.groupBy("departure_airport_iata").agg(F.count(F.lit(1)).alias("n"), F.sum("entries").alias("entries"))


@query("bounded_values", f"SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_quantity BETWEEN 5 AND 40 THEN l_quantity END AS in_range, {R('least(greatest(l_quantity, 5), 40)')} AS clipped FROM lineitem")
def _(spark, sf):
    x = F.col("l_quantity")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", NU.null_out_of_range(x, 5, 40).alias("in_range"), r6(NU.clip(x, 5.0, 40.0), "clipped"))


@query("cleaned_zone", f"{WD} SELECT o_orderkey, CASE raw_zone WHEN '7' THEN 7 WHEN '10' THEN 10 END AS zone, CASE raw_zone WHEN '7' THEN 7 WHEN '10' THEN 10 ELSE CAST(raw_zone_3 AS INT) END AS zone_filled FROM dirty")
def _(spark, sf):
    return _dirty(spark, sf).select(
        "o_orderkey", NU.clean_zone(F.col("raw_zone"), vocab.ZONE_SENTINELS).alias("zone"),
        NU.clean_zone(F.col("raw_zone"), vocab.ZONE_SENTINELS, F.col("raw_zone_3")).alias("zone_filled"),
    )


# The view derives every raw date from the order date, so that is the truth.
_DATE = "CASE WHEN dirty.o_orderkey % 6 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') || CASE dirty.o_orderkey % 6 WHEN 0 THEN ' 10:20:30' WHEN 3 THEN ' 08:00:00' ELSE ' 00:00:00' END END"


@query("parsed_dates", f"{WD} SELECT dirty.o_orderkey, raw_date, {_DATE} AS parsed FROM dirty JOIN orders USING (o_orderkey)")
def _(spark, sf):
    parsed = F.date_format(parse_dates(F.col("raw_date")), "yyyy-MM-dd HH:mm:ss")
    return _dirty(spark, sf).select("o_orderkey", "raw_date", parsed.alias("parsed"))


# Ten layouts of one date; which one a row has follows from its key.
_LAYOUTS = [
    ("d/M/yyyy HH:mm", "%-d/%-m/%Y %H:%M"), ("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M"), ("d MMM yyyy", "%-d %b %Y"), ("MMM d, yyyy", "%b %-d, %Y"), ("MMMM d yyyy", "%B %-d %Y"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "%Y-%m-%dT%H:%M:%S.%g"), ("yyyyMMdd", "%Y%m%d"), ("MM/dd/yyyy", "%m/%d/%Y"), ("dd.MM.yy", "%d.%m.%y"), ("yyyy/M/d HH:mm:ss", "%Y/%-m/%-d %H:%M:%S"),
]
# Month-first text is read as such only if the day cannot be a month; two-digit years belong to this century.
_DAY_MONTH = "CASE WHEN day(o_orderdate) > 12 THEN o_orderdate ELSE make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate), 0, 0, 0) END"
_SHORT_YEAR = "make_timestamp(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate), 0, 0, 0)"


@query(
    "parsed_layouts",
    f"SELECT o_orderkey, strftime(CASE o_orderkey % 10 WHEN 7 THEN {_DAY_MONTH} WHEN 8 THEN {_SHORT_YEAR} ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS parsed FROM orders",
)
def _(spark, sf):
    raw = F.lit(None).cast("string")
    for i, (layout, _) in enumerate(_LAYOUTS):
        raw = F.when(F.col("o_orderkey") % 10 == i, F.date_format("o_orderdate", layout)).otherwise(raw)
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(parse_dates(raw), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("dropped_unparsed", f"{WD} SELECT o_orderkey FROM dirty WHERE o_orderkey % 6 <> 4")
def _(spark, sf):
    return B.drop_unparsed(_dirty(spark, sf).withColumn("d", parse_dates(F.col("raw_date"))), "d").select("o_orderkey")


@query("unparsed_count", f"{WD} SELECT count(CASE WHEN o_orderkey % 6 = 4 THEN 1 END) AS n_unparsed, count(*) AS n_rows FROM dirty")
def _(spark, sf):
    return B.unparsed_count(_dirty(spark, sf).withColumn("d", parse_dates(F.col("raw_date"))), "d")


@query("date_fingerprints", f"{WD} SELECT regexp_replace(regexp_replace(raw_date, '\\d', 'N', 'g'), '[a-zA-Z]', 'A', 'g') AS pattern, count(*) AS n FROM dirty GROUP BY 1")
def _(spark, sf):
    return B.fingerprint_counts(_dirty(spark, sf), "raw_date")


@query("date_fingerprints_digits", f"{WD} SELECT regexp_replace(regexp_replace(raw_date, '[a-zA-Z]', 'A', 'g'), '\\d', 'N', 'g') AS pattern, count(*) AS n FROM dirty GROUP BY 1")
def _(spark, sf):
    return B.fingerprint_counts(_dirty(spark, sf), "raw_date", keep_digits=True)


@query("text_fingerprints", "SELECT regexp_replace(regexp_replace(url, '\\d', 'N', 'g'), '[a-zA-Z]', 'A', 'g') AS pattern, count(*) AS n FROM pages GROUP BY 1")
def _(spark, sf):
    return B.fingerprint_counts(table(spark, sf, "pages"), "url")


@query(
    "calendar_columns",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(isodow(o_orderdate) - 1 AS INT) AS day_of_week, CAST(isodow(o_orderdate) >= 6 AS INT) AS is_weekend FROM orders",
)
def _(spark, sf):
    return B.add_calendar(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "event_date", "year", "month", "day_of_week", "is_weekend")


_MODE = "(SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query(
    "imputed_values",
    f"{WD}, n AS (SELECT *, {_COUNT} AS cnt FROM dirty) SELECT o_orderkey, {R('COALESCE(cnt, (SELECT median(cnt) FROM n))')} AS cnt, COALESCE(raw_risk, {_MODE.format(c='raw_risk')}) AS raw_risk, COALESCE(raw_gender, 'UNKNOWN') AS raw_gender FROM n",
)
def _(spark, sf):
    d = _dirty(spark, sf).select("o_orderkey", NU.parse_count(F.col("raw_count")).alias("cnt"), "raw_risk", "raw_gender")
    return B.impute(d, {"cnt": "median", "raw_risk": "mode", "raw_gender": "constant"}).select("o_orderkey", r6("cnt"), "raw_risk", "raw_gender")


_POLICY = (
    f"{WD}, n AS (SELECT *, {_COUNT} AS cnt FROM dirty), rates AS (SELECT avg(CAST(cnt IS NULL AS INT)) AS a, avg(CAST(raw_risk IS NULL AS INT)) AS b, avg(CAST(raw_gender IS NULL AS INT)) AS c FROM n)"
)


@query(
    "missing_policy_decisions",
    f"{_POLICY}, long AS (SELECT 'cnt' AS column_name, a AS r, 'median' AS how FROM rates UNION ALL SELECT 'raw_risk', b, 'mode' FROM rates UNION ALL SELECT 'raw_gender', c, 'mode' FROM rates) "
    f"SELECT column_name, {R('r')} AS missing_rate, CASE WHEN r > 0.6 THEN 'drop' WHEN r >= 0.2 THEN 'fill_and_flag' WHEN r > 0 THEN 'fill_' || how ELSE 'keep' END AS action FROM long",
)
def _(spark, sf):
    d = _dirty(spark, sf).select("o_orderkey", NU.parse_count(F.col("raw_count")).alias("cnt"), "raw_risk", "raw_gender")
    _, decisions = B.missing_policy(d, exempt=["o_orderkey"])
    return decisions.withColumn("missing_rate", r6("missing_rate"))


@query(
    "rule_violations",
    "SELECT 'iata:c_name' AS rule, count(CASE WHEN NOT regexp_matches(c_name, '^[A-Z]{3}$') THEN 1 END) AS n_violations, count(*) AS n_rows FROM customer "
    "UNION ALL SELECT 'non_negative:c_acctbal', count(CASE WHEN NOT c_acctbal >= 0 THEN 1 END), count(*) FROM customer "
    "UNION ALL SELECT 'percentage:c_acctbal', count(CASE WHEN NOT c_acctbal BETWEEN 0 AND 100 THEN 1 END), count(*) FROM customer",
)
def _(spark, sf):
    return B.validate(table(spark, sf, "customer"), B.business_rules(iata=["c_name"], counts=["c_acctbal"], rates=["c_acctbal"]))


@query("future_date_violations", "SELECT 'not_future:o_orderdate' AS rule, count(CASE WHEN CAST(o_orderdate AS DATE) > DATE '1998-01-01' THEN 1 END) AS n_violations, count(*) AS n_rows FROM orders")
def _(spark, sf):
    rule = {"not_future:o_orderdate": B.not_future_rule("o_orderdate", F.lit("1998-01-01").cast("date"))}
    return B.validate(table(spark, sf, "orders"), rule)


# Whole cleaning chains on raw-shaped columns of the dirty view.
_RAW_GEO = "'s' || lpad(CAST(o_orderkey % 30 AS STRING), 2, '0') AS code"


def _raw_geo():
    return F.concat(F.lit(" s"), F.lpad((F.col("o_orderkey") % 30).cast("string"), 2, "0"))


def _dims(spark, sf):
    nation = table(spark, sf, "nation")
    return B.Dims(view(spark, sf, "airports"), nation.select(F.col("n_name").alias("country"), F.concat(F.lit("I"), F.col("n_nationkey").cast("string")).alias("iso3")))


@query(
    "clean_travelers",
    f"""{with_views('dirty', 'airports')}, raw AS (SELECT *, {_RAW_GEO}, {_COUNT} AS cnt FROM dirty)
SELECT o_orderkey, upper(code) AS "DEPARTURE_AIRPORT_IATA", city AS "DEPARTURE_CITY", airport AS "DEPARTURE_AIRPORT_DESCRIPTION", 'ITALY' AS "ARRIVAL_COUNTRY", 'ITA' AS "ARRIVAL_COUNTRY_CODE",
CASE raw_zone WHEN '7' THEN 7 WHEN '10' THEN 10 END AS "ZONE", COALESCE({_case('upper(raw_gender)', vocab.GENDER, 'upper(raw_gender)')}, 'N.D.') AS "GENDER",
CASE WHEN raw_text IN ('unknown', '-') THEN 'Unknown' ELSE raw_text END AS "NATIONALITY", COALESCE(upper(trim(text_backup)), 'NO_NOTES') AS "OPERATOR_NOTES", CAST(cnt AS INT) AS "ENTRIES", CAST(cnt AS INT) AS "INVESTIGATED", CAST(cnt AS INT) AS "ALARMS"
FROM raw LEFT JOIN airports ON upper(code) = iata WHERE cnt BETWEEN 0 AND 200""",
)
def _(spark, sf):
    raw = _dirty(spark, sf).select(
        "o_orderkey", _raw_geo().alias("DEPARTURE_AIRPORT_IATA"), F.col("raw_zone").alias("ZONE"), F.col("raw_zone_3").alias("ZONE_3"), F.col("raw_gender").alias("GENDER"),
        F.col("raw_text").alias("NATIONALITY"), F.col("text_backup").alias("OPERATOR_NOTES"), F.col("raw_count").alias("ENTRIES"), F.col("raw_count").alias("INVESTIGATED"), F.col("raw_count").alias("ALARMS"),
    )
    return B.clean_travelers(raw, _dims(spark, sf))


@query(
    "clean_alarms",
    f"""{with_views('dirty', 'airports')}, raw AS (SELECT *, {_RAW_GEO}, 'c' || lpad(CAST(o_orderkey % 27 AS STRING), 2, '0') AS arr FROM dirty)
SELECT o_orderkey, upper(code) AS "DEPARTURE_AIRPORT_IATA", d.city AS "DEPARTURE_CITY", d.airport AS "DEPARTURE_AIRPORT_DESCRIPTION", upper(arr) AS "ARRIVAL_AIRPORT_IATA", a.city AS "ARRIVAL_CITY", a.airport AS "ARRIVAL_AIRPORT_DESCRIPTION",
'Italia' AS "ARRIVAL_COUNTRY", 'ITA' AS "ARRIVAL_COUNTRY_CODE", CASE raw_zone WHEN '7' THEN 7 WHEN '10' THEN 10 ELSE CAST(raw_zone_3 AS INT) END AS "ZONE",
CASE o_orderkey % 3 WHEN 0 THEN 'closed_alerts' WHEN 1 THEN 'negative_outcome' END AS "OCCURRENCES", COALESCE(upper(trim(text_backup)), 'NO REASON PROVIDED') AS "ALARM_REASON",
COALESCE({_case('raw_risk', vocab.RISK, 'raw_risk')}, 'LOW RISK') AS "RISK_FLAG", CASE WHEN o_orderkey % 4 = 0 THEN 'NATION_3' ELSE 'NATION_' || (o_orderkey % 30) END AS "DEPARTURE_COUNTRY",
CASE WHEN o_orderkey % 4 = 0 THEN 'I3' WHEN o_orderkey % 30 < 25 THEN 'I' || (o_orderkey % 30) END AS "DEPARTURE_COUNTRY_CODE",
CAST(round_even(COALESCE(CASE WHEN {_FLIGHTS} BETWEEN 0 AND 1000 THEN {_FLIGHTS} END, 0), 0) AS INT) AS "TOTAL_FLIGHTS"
FROM raw LEFT JOIN airports d ON upper(code) = d.iata LEFT JOIN airports a ON a.iata = upper(arr)""",
)
def _(spark, sf):
    k = F.col("o_orderkey")
    raw = _dirty(spark, sf).select(
        "o_orderkey", _raw_geo().alias("DEPARTURE_AIRPORT_IATA"), F.concat(F.lit("c"), F.lpad((k % 27).cast("string"), 2, "0"), F.lit(" ")).alias("ARRIVAL_AIRPORT_IATA"), F.col("raw_zone").alias("ZONE"), F.col("raw_zone_3").alias("ZONE_3"),
        F.when(k % 3 == 0, "Allarmi Chiusi ").when(k % 3 == 1, "RESPINTO/A").otherwise("n/c").alias("OCCURRENCES"),
        F.col("text_backup").alias("ALARM_REASON"), F.col("raw_risk").alias("RISK_FLAG"),
        F.when(k % 4 == 0, " NATION_3").otherwise("?").alias("DEPARTURE_COUNTRY_FULL"), F.concat(F.lit("NATION_"), (k % 30).cast("string")).alias("DEPARTURE_COUNTRY"),
        F.col("raw_flights").alias("TOTAL_FLIGHTS"), F.lit("x").alias("TOTAL"),
    )
    return B.clean_alarms(raw, _dims(spark, sf))


# Tables written out and read back. An empty cell and an empty text are both missing once they have been a CSV cell.
@query("csv_round_trip", "SELECT CAST(page_id AS VARCHAR) AS page_id, nullif(url, '') AS url, nullif(html, '') AS html FROM pages")
def _(spark, sf):
    """Markup with quotes, commas and line breaks."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf, "pages"), path)
    return scan_csv(spark, path)


@query("csv_texts_round_trip", "SELECT doc_id, CASE WHEN text NOT IN ('', 'NA', 'NULL', 'null', 'nan', 'NaN', 'None', 'N/A', 'n/a') THEN text END AS text FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf, "documents").select("doc_id", "text"), path)
    return scan_csv(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


@query("json_round_trip", "SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "json")
    write_json(table(spark, sf, "orders"), path)
    back = spark.read.schema("o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").json(path)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("report_round_trip", "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1")
def _(spark, sf):
    """Every line of every body, read back."""
    path = scratch_path(spark, "reports")
    write_report(table(spark, sf, "documents").select(F.col("text").alias("report_md")), path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


_LOADED = f"""WITH raw AS (SELECT o_orderkey, o_orderdate, 's' || lpad(CAST(o_orderkey % 30 AS STRING), 2, '0') AS code, o_custkey % 300 AS n, o_orderkey % 7 AS u FROM orders),
airports AS ({VIEWS['airports']})"""


@query(
    "loaded_clean_data",
    f"""{_LOADED} SELECT CAST("DEPARTURE_DATE" AS STRING) AS departure_date, code, city, notes, entries FROM (
    SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "DEPARTURE_DATE", upper(code) AS code, city, 'SAID "' || o_orderkey || '",' || chr(10) || 'THEN LEFT' AS notes, n AS entries
    FROM raw LEFT JOIN airports ON upper(code) = iata WHERE u <> 3 AND n <= 200)""",
)
def _(spark, sf):
    """Raw files with quotes and line breaks in cells, read and cleaned; undated rows leave."""
    return B.load_clean_data(spark, _raw_files(spark, sf), _dims(spark, sf))[1].select(
        F.date_format("DEPARTURE_DATE", "yyyy-MM-dd HH:mm:ss").alias("departure_date"), F.col("DEPARTURE_AIRPORT_IATA").alias("code"), F.col("DEPARTURE_CITY").alias("city"),
        F.col("OPERATOR_NOTES").alias("notes"), F.col("ENTRIES").cast("bigint").alias("entries"),
    )


@query(
    "undated_rows",
    f"{_LOADED} SELECT count(*) FILTER (u = 3) AS n_unparsed, count(*) AS n_rows, 'alarms' AS source FROM raw UNION ALL SELECT count(*) FILTER (u = 3), count(*), 'travelers' FROM raw WHERE n <= 200",
)
def _(spark, sf):
    return B.undated_rows(spark, _raw_files(spark, sf), _dims(spark, sf))


def _raw_files(spark, sf) -> str:
    """Both raw tables, made from all orders, as CSV folders."""
    folder = scratch_path(spark, "raw")
    k = F.col("o_orderkey")
    notes = F.concat(F.lit('said "'), k.cast("string"), F.lit('",\nthen left'))
    date = F.when(k % 7 == 3, "unknown").when(k % 2 == 0, F.date_format("o_orderdate", "d MMM yyyy HH:mm:ss")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))
    n = (F.col("o_custkey") % 300).cast("string")
    base = table(spark, sf, "orders").select(
        F.lit("c01").alias("AREOPORTO_ARRIVO"), F.concat(F.lit("s"), F.lpad((k % 30).cast("string"), 2, "0")).alias("AREOPORTO_PARTENZA"), date.alias("DATA_PARTENZA"),
        notes.alias("note_operatore"), n.alias("ENTRATI"), n.alias("INVESTIGATI"), n.alias("ALLARMATI"), F.lit("Allarmi Chiusi").alias("OCCORRENZE"), F.lit("1 voli").alias("tot voli"),
    )
    write_csv(base.drop("OCCORRENZE", "tot voli"), f"{folder}/TIPOLOGIA_VIAGGIATORE.csv")
    write_csv(base.drop("ENTRATI", "INVESTIGATI", "ALLARMATI"), f"{folder}/ALLARMI.csv")
    return folder
