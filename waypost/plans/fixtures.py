"""Views that give the star-schema test tables the shape of the two source tables.

Departure is the supplier's nation and arrival the customer's nation. The same
SQL text runs in Spark and, for the oracles, in DuckDB. No row is left out:
routes that exist on one side only have an arrival code of their own there
(``T`` for travellers, ``A`` for alarms), and some codes are missing on both
sides at once, others on the alarm side alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waypost.operators.routes import Categories

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

TRAVELERS = """
SELECT CAST(o_orderdate AS DATE) AS departure_date,
       CASE WHEN (s_nationkey * 5 + c_nationkey) % 31 <> 0 THEN 'S' || lpad(CAST(s_nationkey AS STRING), 2, '0') END AS departure_airport_iata,
       CASE WHEN (s_nationkey * 3 + c_nationkey) % 13 = 0 THEN 'T' ELSE 'C' END || lpad(CAST(c_nationkey AS STRING), 2, '0') AS arrival_airport_iata,
       c_mktsegment AS nationality, o_orderstatus AS control_outcome,
       l_returnflag AS document_type2, n_regionkey AS zone,
       CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS entries,
       CAST(SUM(CAST(floor(l_quantity * (1 - l_discount)) AS INT)) AS BIGINT) AS investigated,
       CAST(SUM(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                     THEN CAST(floor(l_quantity * l_tax) AS INT) ELSE 0 END
                * CASE WHEN (s_nationkey * 7 + c_nationkey) % 97 = 0 THEN 8 ELSE 1 END) AS BIGINT) AS alarms
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey
GROUP BY 1, 2, 3, 4, 5, 6, 7
"""

ALARMS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(o_orderdate AS DATE) AS departure_date,
       CASE WHEN (s_nationkey * 5 + c_nationkey) % 31 <> 0 THEN 'S' || lpad(CAST(s_nationkey AS STRING), 2, '0') END AS departure_airport_iata,
       CASE WHEN (s_nationkey + c_nationkey * 7) % 43 <> 0
            THEN CASE WHEN (s_nationkey + c_nationkey) % 11 = 0 THEN 'A' ELSE 'C' END || lpad(CAST(c_nationkey AS STRING), 2, '0') END AS arrival_airport_iata,
       n_name AS departure_country, n_regionkey AS zone,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE lower(l_returnflag || '_' || l_linestatus) END AS occurrences,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'NO REASON PROVIDED' ELSE o_orderpriority END AS alarm_reason,
       CASE WHEN o_orderpriority = '1-URGENT' AND l_quantity > 45 THEN 'HIGH RISK'
            WHEN o_orderpriority = '2-HIGH' AND l_quantity > 45 THEN 'MEDIUM RISK'
            ELSE 'LOW RISK' END AS risk_flag,
       CAST(l_quantity AS INT) AS total_flights
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey
"""

DIRTY = """
SELECT o_orderkey,
       CASE o_orderkey % 6
         WHEN 0 THEN CAST(o_custkey % 300 AS STRING) || ' pax'
         WHEN 1 THEN '~' || CAST(o_custkey % 300 AS STRING)
         WHEN 2 THEN 'N.D.'
         WHEN 3 THEN CAST(o_custkey % 300 AS STRING) || ',0'
         WHEN 4 THEN '-500'
         ELSE CAST(o_custkey % 300 AS STRING) END AS raw_count,
       CASE o_orderkey % 3
         WHEN 0 THEN CAST(o_custkey % 1500 AS STRING) || ' voli'
         WHEN 1 THEN '~' || CAST(o_custkey % 50 AS STRING)
         ELSE '??' END AS raw_flights,
       CASE o_orderkey % 6
         WHEN 0 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING) || ' 10:20:30'
         WHEN 1 THEN CAST(year(o_orderdate) AS STRING) || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')
         WHEN 2 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '.' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '.' || CAST(year(o_orderdate) AS STRING)
         WHEN 3 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '08:00:00'
         WHEN 4 THEN 'n.d.'
         ELSE CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || ' 00:00:00' END AS raw_date,
       CASE o_custkey % 8 WHEN 0 THEN 'Maschio' WHEN 1 THEN '1' WHEN 2 THEN 'female' WHEN 3 THEN '2'
         WHEN 4 THEN '//' WHEN 5 THEN 'N/B' WHEN 6 THEN 'M' ELSE NULL END AS raw_gender,
       CASE o_custkey % 5 WHEN 0 THEN '-1' WHEN 1 THEN '99' WHEN 2 THEN '??' WHEN 3 THEN '7' ELSE '10' END AS raw_zone,
       CAST(o_custkey % 10 AS STRING) AS raw_zone_3,
       CASE o_custkey % 4 WHEN 0 THEN ' ' || lower(o_orderpriority) || ' ' WHEN 1 THEN 'unknown' WHEN 2 THEN '-' ELSE o_orderpriority END AS raw_text,
       CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE upper(o_orderpriority) END AS text_backup,
       CASE o_orderstatus WHEN 'F' THEN 'ALTO' WHEN 'O' THEN 'MEDIO' ELSE NULL END AS raw_risk
FROM orders
"""

# Airport directory of the test views: one departure and one arrival code per
# nation. Nations 7 and 17 share a city name, so that city has two codes.
AIRPORTS = """
SELECT 'S' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS iata,
       CASE WHEN n_nationkey IN (7, 17) THEN 'Twin Port' ELSE 'Port ' || n_name END AS city,
       n_name || ' Main' AS airport, n_nationkey AS ord
FROM nation
UNION ALL
SELECT 'C' || lpad(CAST(n_nationkey AS STRING), 2, '0'), 'Bay ' || n_name, n_name || ' Bay', 100 + n_nationkey
FROM nation
"""

# Requests: one per customer, six kinds of phrase.
REQUESTS = """
SELECT c_custkey AS request_id,
       CASE c_custkey % 6
         WHEN 0 THEN 'anomalies from S' || lpad(CAST(c_nationkey AS STRING), 2, '0')
         WHEN 1 THEN 'flights to C' || lpad(CAST(c_nationkey * 2 AS STRING), 2, '0')
         WHEN 2 THEN 'voli da port ' || lower(n_name)
         WHEN 3 THEN 'arriving ' || n_name || ' via ZZZ'
         WHEN 4 THEN CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE 'flights from ZZZ' END
         ELSE 'twin port or S' || lpad(CAST(c_nationkey + 20 AS STRING), 2, '0') || ' and C01' END AS user_request
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
TOKEN = "[A-Z][0-9]{2}"

VIEWS = {"travelers": TRAVELERS, "alarms": ALARMS, "dirty": DIRTY, "airports": AIRPORTS, "requests": REQUESTS}

# Frozen category values of the views.
CATEGORIES = Categories(
    occurrences=["a_f", "a_o", "n_f", "n_o", "r_f", "r_o"],
    nationalities=["AUTOMOBILE", "BUILDING", "FURNITURE"],
    documents=["A", "N", "R"],
    outcomes=["F", "O", "P"],
)
PANEL_VALUES = {
    "alarm_reason": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "NO REASON PROVIDED"],
    "risk_flag": ["HIGH RISK", "MEDIUM RISK", "LOW RISK"],
}
PANEL_ORDER = ["departure_date", "arrival_airport_iata", "nationality", "control_outcome", "document_type2", "zone"]


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is inferred once per process."""
    path = f"{sf}/{name}.parquet"
    if (sf, name) not in _SCHEMAS:
        _SCHEMAS[sf, name] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[sf, name]).parquet(path)


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the shaped views over the tables in ``sf``."""
    text = VIEWS[name]
    for t in TABLES:
        if re.search(rf"\b(FROM|JOIN) {t}\b", text):
            table(spark, sf, t).createOrReplaceTempView(t)
    return spark.sql(text)


CODED = "departure_airport_iata IS NOT NULL AND arrival_airport_iata IS NOT NULL"


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the given views, for oracle SQL.

    ``coded_travelers`` and ``coded_alarms`` are their rows that belong to a route.
    """
    parts = [f"{n} AS ({VIEWS[n]})" for n in names]
    parts += [f"coded_{n} AS (SELECT * FROM {n} WHERE {CODED})" for n in names if n in ("travelers", "alarms")]
    return "WITH " + ",\n".join(parts)
