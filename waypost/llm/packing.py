"""Length buckets with the least padding, and token-budget batches inside them.

Rows are padded to the upper boundary of their bucket. The boundaries come
from dynamic programming over the global length histogram. Histogram bins are
exact below 256 and 64 to the octave above, so that there are fewer than 4 200
bins for any 64-bit length; the candidates are the largest lengths in the bins.

Inside a bucket rows are put in the order of a hash of their key. A batch takes
as many rows as the token budget allows at the bucket's boundary, one at least.
Positions are global: rows are numbered inside (bucket, shard) and each shard
starts where the one before it ends, so that no task holds a whole bucket.

A null length counts as 0, a null key is a key like any other, rows that repeat
a key each get a place. An empty table gives no buckets and no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waypost.session import materialize

BUCKETS = 12
TOKEN_BUDGET = 65_536
SEED = "pack-1"
#: Rows that one (bucket, shard) window is meant to hold at most.
SHARD_ROWS = 1 << 20


class Bucket(NamedTuple):
    bucket: int
    boundary: int
    capacity: int
    rows: int
    tokens: int


def bin_of(length: Column) -> Column:
    """Histogram bin: the length itself below 256, then 64 bins to the octave."""
    octave = F.length(F.bin(length)) - 1
    step = F.expr("1L").cast("bigint") * F.pow(F.lit(2.0), octave - 6).cast("bigint")
    return F.when(length < 256, length).otherwise(octave * 64 + (length - step * 64) / step).cast("bigint")


def best_boundaries(longest: np.ndarray, rows: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Indices of the bins that end a bucket, so that padding is least; ties take the earlier cut.

    Bins are in ascending order. cost(j, i) pads bins j+1..i to longest[i].
    """
    n = len(longest)
    if not n:
        return []
    r, t = np.concatenate([[0], np.cumsum(rows)]), np.concatenate([[0], np.cumsum(tokens)])
    best = longest * r[1:] - t[1:]
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, n) - 1):
        grown, cut = best.copy(), np.full(n, -1)
        for i in range(1, n):
            total = best[:i] + longest[i] * (r[i + 1] - r[1 : i + 1]) - (t[i + 1] - t[1 : i + 1])
            j = int(np.argmin(total))
            if total[j] < grown[i]:
                grown[i], cut[i] = total[j], j
        cuts.append(cut)
        best = grown
    ends, i = [n - 1], n - 1
    for cut in reversed(cuts):
        if cut[i] >= 0:
            i = int(cut[i])
            ends.append(i)
    return ends[::-1]


def fit_buckets(lengths: DataFrame, length: str = "n_tokens", buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> list[Bucket]:
    """Buckets over the whole histogram; fewer than 4 200 rows reach the driver."""
    n = F.coalesce(F.col(length), F.lit(0)).cast("bigint")
    rows = lengths.select(n.alias("n")).groupBy(bin_of(F.col("n")).alias("bin")).agg(F.max("n").alias("longest"), F.count("*").alias("rows"), F.sum("n").alias("tokens")).collect()
    rows.sort(key=lambda r: r.bin)
    longest, count, tokens = (np.array([r[k] for r in rows], dtype=np.int64) for k in ("longest", "rows", "tokens"))
    out, start = [], 0
    for k, end in enumerate(best_boundaries(longest, count, tokens, buckets)):
        edge = int(longest[end])
        out.append(Bucket(k, edge, max(1, token_budget // max(1, edge)), int(count[start : end + 1].sum()), int(tokens[start : end + 1].sum())))
        start = end + 1
    return out


def pack(docs: DataFrame, length: Column, key: str = "doc_id", buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, seed: str = SEED) -> DataFrame:
    """key, n_tokens, bucket, boundary, capacity, batch, slot (place in the batch), padding."""
    lengths = materialize(docs.select(F.col(key).alias("k"), F.coalesce(length, F.lit(0)).cast("bigint").alias("n"), F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null")))).alias("h")))
    fitted = fit_buckets(lengths, "n", buckets, token_budget)
    digits = 1
    while max([0, *(b.rows for b in fitted)]) / 16**digits > SHARD_ROWS:
        digits += 1
    number, edge, room = (F.lit(None).cast("bigint") for _ in range(3))
    for b in reversed(fitted):
        inside = F.col("n") <= b.boundary
        number, edge, room = (F.when(inside, F.lit(v).cast("bigint")).otherwise(c) for v, c in ((b.bucket, number), (b.boundary, edge), (b.capacity, room)))
    placed = lengths.select("k", "n", "h", F.substring("h", 1, digits).alias("shard"), number.alias("bucket"), edge.alias("boundary"), room.alias("capacity"))
    starts = (
        placed.groupBy("bucket", "shard").count()
        .withColumn("start", F.sum("count").over(Window.partitionBy("bucket").orderBy("shard")) - F.col("count"))
        .drop("count")
    )
    place = F.col("start") + F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("h", "k", "n")) - 1
    return placed.join(starts, ["bucket", "shard"]).withColumn("place", place).select(
        F.col("k").alias(key), F.col("n").alias("n_tokens"), "bucket", "boundary", "capacity",
        F.floor(F.col("place") / F.col("capacity")).cast("bigint").alias("batch"),
        F.pmod(F.col("place"), F.col("capacity")).alias("slot"),
        (F.col("boundary") - F.col("n")).alias("padding"),
    )


def pack_sql(lengths: str, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, seed: str = SEED) -> str:
    """SQL twin over a subquery with columns doc_id and n."""
    octave = "length(bin(n)) - 1"
    step = f"CAST(pow(2, {octave} - 6) AS BIGINT)"
    out = [
        f"WITH lengths AS ({lengths})",
        f"binned AS (SELECT *, CASE WHEN n < 256 THEN n ELSE ({octave}) * 64 + (n - 64 * {step}) // {step} END AS bin FROM lengths)",
        "hist AS (SELECT row_number() OVER (ORDER BY bin) AS i, max(n) AS e, sum(count(*)) OVER (ORDER BY bin) AS r, sum(sum(n)) OVER (ORDER BY bin) AS t FROM binned GROUP BY bin)",
        "d1 AS (SELECT i, e, r, t, e * r - t AS cost, [i] AS ends FROM hist)",
    ]
    for k in range(2, buckets + 1):
        out.append(
            f"c{k} AS (SELECT h.i, h.e, h.r, h.t, p.cost + h.e * (h.r - p.r) - (h.t - p.t) AS cost, list_append(p.ends, h.i) AS ends, p.i AS j FROM hist h JOIN d{k - 1} p ON p.i < h.i UNION ALL SELECT i, e, r, t, cost, ends, -1 FROM d{k - 1}),\n"
            f"d{k} AS (SELECT i, e, r, t, min(cost) AS cost, arg_min(ends, (cost, j)) AS ends FROM c{k} GROUP BY i, e, r, t)"
        )
    out += [
        f"edges AS (SELECT unnest(ends) AS i FROM (SELECT ends FROM d{buckets} ORDER BY i DESC LIMIT 1))",
        f"edge AS (SELECT row_number() OVER (ORDER BY e) - 1 AS bucket, e AS boundary, greatest(1, {token_budget} // greatest(1, e)) AS capacity FROM hist JOIN edges USING (i))",
        f"placed AS (SELECT doc_id, n, bucket, boundary, capacity, row_number() OVER (PARTITION BY bucket ORDER BY md5('{seed}:' || CAST(doc_id AS VARCHAR)), doc_id, n) - 1 AS place FROM lengths ASOF JOIN edge ON n <= boundary)",
    ]
    return ",\n".join(out) + (
        "\nSELECT doc_id, n AS n_tokens, CAST(bucket AS BIGINT) AS bucket, CAST(boundary AS BIGINT) AS boundary, CAST(capacity AS BIGINT) AS capacity,"
        " CAST(place // capacity AS BIGINT) AS batch, CAST(place % capacity AS BIGINT) AS slot, CAST(boundary - n AS BIGINT) AS padding FROM placed"
    )
