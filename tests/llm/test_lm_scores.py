import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waypost.llm import lm_scores


def brute(rows, targets, order=5, strength=8.0):
    counts, contexts, letters = [Counter(), Counter()], [Counter(), Counter()], set()
    marked = [(d, ["^"] * (order - 1) + list(t or "")) for d, t in rows]
    for d, s in marked:
        letters |= set(s[order - 1 :])
        for m in (0, 1) if d in targets else (1,):
            for i in range(order - 1, len(s)):
                for n in range(1, order + 1):
                    counts[m][tuple(s[i - n + 1 : i + 1])] += 1
                    contexts[m][n, tuple(s[i - n + 1 : i])] += 1

    def p(m, s, i):
        q = 1 / (len(letters) + 1)
        for n in range(1, order + 1):
            q = (counts[m][tuple(s[i - n + 1 : i + 1])] + strength * q) / (contexts[m][n, tuple(s[i - n + 1 : i])] + strength)
        return q

    return [(d, len(s) - order + 1, sum(math.log(p(1, s, i)) - math.log(p(0, s, i)) for i in range(order - 1, len(s)))) for d, s in marked]


@pytest.mark.parametrize("order,part,piece", [(5, 1 << 24, 1 << 20), (5, 700, 1 << 20), (4, 700, 64), (6, 1 << 24, 64)])
def test_scores_match_brute_force(spark, monkeypatch, edge_rows, order, part, piece):
    monkeypatch.setattr(lm_scores, "PIECE", piece)
    monkeypatch.setattr(lm_scores, "MERGE_ROWS", 500)
    rows = [(d, t) for d, t, *_ in edge_rows if len(t or "") < 3_000]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    targets = spark.createDataFrame([(5,), (5,), (8,), (None,), (777,)], "doc_id bigint")
    got = lm_scores.score(df, targets, order=order, part_bytes=part).collect()
    want = brute(rows, {5, 8}, order)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[2], 6))
    for mine, other in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert mine[:2] == other[:2] and mine.loss_difference == pytest.approx(other[2], abs=1e-6)
        assert mine.score is None if not other[1] else mine.score == pytest.approx(other[2] / other[1], abs=1e-9)


def test_edges(edge_docs, no_docs):
    got = lm_scores.score(edge_docs, edge_docs.where("doc_id = 4").select("doc_id"))
    assert got.count() == edge_docs.count() and got.where("text IS NULL" if "text" in got.columns else "score IS NULL").count() == 3
    assert lm_scores.score(no_docs, no_docs.select("doc_id")).count() == 0
    none = lm_scores.score(edge_docs, no_docs.select("doc_id"))
    assert none.count() == edge_docs.count()


def test_target_documents_score_lower(spark, sf):
    from waypost.llm.queries import cross_entropy_difference

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    mean = {r.quality: r.s for r in cross_entropy_difference(spark, sf).join(labels, "doc_id").groupBy("quality").agg(F.avg("score").alias("s")).collect()}
    assert mean[1] < mean[0]
