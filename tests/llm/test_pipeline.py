import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry_points
from check_oracles import canonical
from waypost.llm import pii, quality, registry
from waypost.llm.common import table
from waypost.session import materialize

TOP = Path(__file__).resolve().parents[2]


def test_every_operator_has_its_query():
    registry.load_all()
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["op2_length_buckets", "op7_chat_format", "op10_rule_cascade", "op11_octopus_multiproof", "op12_blocked_search", "op13_seekable_warc"])
def test_oracles(spark, sf, name):
    registry.load_all()
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = registry.QUERIES[name](spark, sf)
    cur = con.execute(registry.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cur.fetchall(), cols)


def test_stages(spark, sf):
    from test_simhash import grouped, plain

    docs = table(spark, sf, "documents")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf))
        assert docs.columns == columns, name
        have, had = ({r.doc_id: r for r in d.collect()} for d in (docs, before))
        if name == "quality rules":
            assert set(have) == {d for d, r in had.items() if quality.first_rejection(quality.Text(r.text), quality.RULES) is None}
        if name == "near-duplicates":
            ids = sorted(had)
            assert set(have) == {ids[i] for i in grouped([plain(had[d].text) for d in ids])}
        if name == "personal data":
            assert set(have) == set(had)
            for d, r in have.items():
                assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)
                assert r.text == had[d].text or pii._HINT.search(had[d].text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert sorted(r.doc_id for r in packed.collect()) == sorted(r.doc_id for r in docs.collect())


def test_edges_go_through_all_stages(spark, sf, edge_docs, no_docs):
    """Nulls, repeated rows, clashing names, no column n_chars, and an empty table."""
    for docs, n in ((edge_docs, 4), (edge_docs.drop("n_chars"), 4), (no_docs, 0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns, docs = docs.columns, materialize(stage(spark, docs, sf))
            assert docs.columns == columns
        kept = docs.collect()
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
        assert len(kept) == len(packed) and sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in packed)
        assert sorted(r.doc_id for r in kept) == [4, 5, 12, 12][:n]


def test_entry_works_without_the_operators(tmp_path):
    for p in TOP.iterdir():
        if p.name not in ("corpus_pipeline.py", "waypost", ".git", "tests"):
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "waypost").mkdir()
    for p in (TOP / "waypost").iterdir():
        if p.name != "llm":
            (tmp_path / "waypost" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); assert len(q) > 200 and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"})
