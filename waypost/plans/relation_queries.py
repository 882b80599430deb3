"""Joins, set operations, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from waypost.operators import joins as J
from waypost.operators import ordering as S
from waypost.plans.fixtures import table, view, with_views
from waypost.plans.registry import R, query, r6
from waypost.session import materialize

KEYS = ["departure_airport_iata", "arrival_airport_iata"]
K = ", ".join(KEYS)
BOTH = with_views("travelers", "alarms")
SIDES = f"{BOTH}, a AS (SELECT {K}, count(*) AS n_a FROM alarms GROUP BY {K}), t AS (SELECT {K}, count(*) AS n_t FROM travelers GROUP BY {K})"

CODED_SIDES = SIDES.replace("FROM alarms GROUP", "FROM coded_alarms GROUP").replace("FROM travelers GROUP", "FROM coded_travelers GROUP")


def _sides(spark, sf):
    a = view(spark, sf, "alarms").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_a"))
    t = view(spark, sf, "travelers").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_t"))
    return a, t


@query(
    "coverage_join",
    f"{SIDES} SELECT {K}, n_a, n_t, CASE WHEN n_a IS NULL THEN 'right_only' WHEN n_t IS NULL THEN 'left_only' ELSE 'both' END AS data_coverage FROM a FULL JOIN t USING ({K})",
)
def _(spark, sf):
    return J.outer_join_with_coverage(*_sides(spark, sf), KEYS)


@query("left_join_fill0", f"{SIDES} SELECT {K}, n_t, COALESCE(n_a, 0) AS n_a FROM t LEFT JOIN a USING ({K})")
def _(spark, sf):
    a, t = _sides(spark, sf)
    return J.left_join_fill0(t, a, KEYS, ["n_a"])


@query("group_statistic", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {R('avg(l_quantity) OVER (PARTITION BY l_suppkey)')} AS avg_quantity FROM lineitem")
def _(spark, sf):
    out = J.attach_group_stat(table(spark, sf, "lineitem"), ["l_suppkey"], avg_quantity=F.avg("l_quantity"))
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", r6("avg_quantity"))


@query("merged_tables", f"{SIDES} SELECT {K}, n_a, n_t FROM a JOIN t USING ({K})")
def _(spark, sf):
    a, t = _sides(spark, sf)
    return J.merge_with_loss(a, t, [*KEYS, "not_shared"])[0]


@query(
    "merge_loss",
    "WITH m AS (SELECT count(*) AS n FROM orders JOIN supplier ON o_custkey % 150 = s_suppkey), s AS (SELECT (SELECT count(*) FROM orders) AS n_left, (SELECT count(*) FROM supplier) AS n_right) "
    f"SELECT n_left, n_right, n AS n_merged, {R('100.0 * (1 - n / least(n_left, n_right))')} AS loss_pct, CAST(100.0 * (1 - n / least(n_left, n_right)) > 20 AS INT) AS warn FROM m CROSS JOIN s",
)
def _(spark, sf):
    """Keys that repeat on the left, and a smaller right side."""
    a = table(spark, sf, "orders").select((F.col("o_custkey") % 150).alias("k"))
    return J.merge_with_loss(a, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")), ["k"])[1].withColumn("loss_pct", r6("loss_pct"))


@query(
    "merge_loss_routes",
    f"{CODED_SIDES}, m AS (SELECT count(*) AS n FROM a JOIN t USING ({K})), s AS (SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM t) AS n_right) "
    f"SELECT n_left, n_right, n AS n_merged, {R('100.0 * (1 - n / least(n_left, n_right))')} AS loss_pct, CAST(100.0 * (1 - n / least(n_left, n_right)) > 20 AS INT) AS warn FROM m CROSS JOIN s",
)
def _(spark, sf):
    a, t = (df.dropna(subset=KEYS) for df in _sides(spark, sf))
    return J.merge_with_loss(a, t, KEYS)[1].withColumn("loss_pct", r6("loss_pct"))


@query("equality_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def _(spark, sf):
    return J.filter_in(table(spark, sf, "orders"), "o_orderstatus", ["F", "P"]).select("o_orderkey")


@query("range_filter", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02 AND 0.05")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.filter(F.col("l_quantity").between(10, 20) & F.col("l_discount").between(0.02, 0.05)).select("l_orderkey", "l_partkey")


@query("conditional_column", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' ELSE 'small' END AS size FROM orders")
def _(spark, sf):
    price = F.col("o_totalprice")
    size = F.when(price > 200000, "large").when(price > 100000, "medium").otherwise("small")
    return table(spark, sf, "orders").select("o_orderkey", size.alias("size"))


@query("pattern_filter", "SELECT conv_id, turn FROM conversations WHERE regexp_matches(text, '(?i)\\b(to|arrival|arriving|arriva|atterra|verso)\\b')")
def _(spark, sf):
    return table(spark, sf, "conversations").filter(F.col("text").rlike(r"(?i)\b(to|arrival|arriving|arriva|atterra|verso)\b")).select("conv_id", "turn")


@query("semi_join", f"{SIDES} SELECT {K}, n_a FROM a SEMI JOIN t USING ({K})")
def _(spark, sf):
    a, t = _sides(spark, sf)
    return J.semi(a, t, KEYS)


@query("anti_join", f"{SIDES} SELECT {K}, n_a FROM a ANTI JOIN t USING ({K})")
def _(spark, sf):
    a, t = _sides(spark, sf)
    return J.anti(a, t, KEYS)


@query("attached_scores", "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)")
def _(spark, sf):
    return J.attach_scores(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"])


_COVER = (
    f"{CODED_SIDES} SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM t) AS n_right, (SELECT count(*) FROM a SEMI JOIN t USING ({K})) AS n_shared, "
    f"(SELECT count(*) FROM a ANTI JOIN t USING ({K})) AS n_left_only, (SELECT count(*) FROM t ANTI JOIN a USING ({K})) AS n_right_only, "
    f"{R(f'(SELECT count(*) FROM a SEMI JOIN t USING ({K})) / (SELECT count(*) FROM a FULL JOIN t USING ({K}))')} AS jaccard"
)


@query("route_key_coverage", _COVER)
def _(spark, sf):
    out = J.key_coverage(view(spark, sf, "alarms"), view(spark, sf, "travelers"), KEYS)
    return out.withColumn("jaccard", r6("jaccard"))


@query("compared_runs", _COVER)
def _(spark, sf):
    a, t = _sides(spark, sf)
    return J.compare_runs(a, t, KEYS).withColumn("jaccard", r6("jaccard"))


def _set_op(name):
    def run(spark, sf):
        return J.set_ops(*_sides(spark, sf), KEYS)[name]

    return run


query("key_intersection", f"{SIDES} SELECT {K} FROM a INTERSECT SELECT {K} FROM t")(_set_op("intersection"))
query("key_union", f"{SIDES} SELECT {K} FROM a UNION SELECT {K} FROM t")(_set_op("union"))
query("key_difference", f"{SIDES} SELECT {K} FROM a EXCEPT SELECT {K} FROM t")(_set_op("difference"))


@query("top_orders", f"SELECT o_orderkey, {R('o_totalprice')} AS o_totalprice FROM orders ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, sf):
    out = S.top_n(table(spark, sf, "orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)
    return out.select("o_orderkey", r6("o_totalprice"))


@query("distinct_pairs", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _(spark, sf):
    return S.distinct_rows(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("distinct_count", "SELECT count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_returnflag) AS n_flags FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count_distinct("l_suppkey").alias("n_suppliers"), F.count_distinct("l_returnflag").alias("n_flags"))


@query("most_frequent_value", "SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2) WHERE rn = 1")
def _(spark, sf):
    return S.most_frequent(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority")


@query("order_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def _(spark, sf):
    """Global rank over range partitions."""
    out = S.global_rank(table(spark, sf, "orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], max_rows=2000)
    return out.select("o_orderkey", "rank")
