import hashlib
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from waypost.llm import warc

SCHEMA = "page_id bigint, url string, html string, first string, digest string, payload string, n string"


def pages_of(seed=2, n=120):
    rng = random.Random(seed)
    words = lambda k: " ".join(rng.choice(["<p>", "é", "日本", "\r\n\r\n", "WARC/1.1", "text"]) for _ in range(k))
    shared, long = words(60), words(50_000)
    rows = [(i, rng.choice([f"http://a.example/{i}?q=a b\nc%20é", None, ""]), words(rng.randint(0, 80))) for i in range(n)]
    rows += [(1000 - i, "http://b.example", shared) for i in range(150)]  # a third of all rows
    rows += [(2000 + i, "u", rows[i % 7][2]) for i in range(30)] + [(3000 + i, "u", "a" * (97 + i // 2)) for i in range(8)]
    rows += [(4000, "u", long), (4001, "u", long), (4002, "u", None), (4003, "u", ""), (4004, "u", None)]
    rows += [(None, "u", shared), (None, None, words(90)), (851, "again", shared), (5, "again", rows[5][2]), (None, "v", "z" * 200), (None, "w", "z" * 200)]
    return rows


def brute(rows):
    first = {}
    for key, _, html in rows:
        if key is not None:
            first[html] = min(first.get(html, key), key)
    out = []
    for key, _, html in rows:
        raw = (html or "").encode()
        other = first.get(html) if len(raw) >= 100 else None
        revisit = other is not None and other != key
        out.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return sorted(out, key=str)


def records(index, folder, **how):
    key = lambda c: warc.key_column(F.col(c)).cast("bigint")
    return warc.read(index, folder, **how).withColumn("key", key("record_id")).withColumn("other", key("refers_to"))


@pytest.mark.parametrize(("frame", "bundle", "hot"), [(1, 1, 4), (3000, 2000, 4), (1 << 20, 256 << 20, 4096)])
def test_round_trip(spark, tmp_path, monkeypatch, frame, bundle, hot):
    monkeypatch.setattr(warc, "HOT_SHARE", hot)
    rows, folder = pages_of(), str(tmp_path / "archive")
    pages = spark.createDataFrame([(*r, *"abcd") for r in rows], SCHEMA).repartition(5)
    index = warc.write(pages, folder, frame=frame, bundle=bundle)
    got = records(index, folder).collect()
    assert sorted([(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.other) for r in got], key=str) == brute(rows)
    content = sorted((r[2] or "").encode() for r in rows)
    whole = {hashlib.sha256(c).hexdigest(): c for c in content}
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit") and (r.payload is None or bytes(r.payload) == whole[r.payload_digest])
    # Any reader unpacks a bundle as a whole; the index gives places in the unpacked frames.
    places = index.collect()
    for name in {p.bundle for p in places}:
        packed = (tmp_path / "archive" / name).read_bytes()
        raw = zstandard.ZstdDecompressor().stream_reader(packed, read_across_frames=True).read()
        with open(tmp_path / "archive" / name, "rb") as file:
            table = warc.seek_table(_Sized(file, len(packed)))
            assert sum(t[2] for t in table) == len(raw)
            for p in (p for p in places if p.bundle == name):
                one = warc.read_frame(file, *table[p.frame])[p.offset : p.offset + p.length]
                (_, length, fields, _, _), = warc.parse_records(one)
                assert length == p.length and fields["warc-record-id"] == f"<{p.record_id}>"
    assert len(places) == len(rows)
    if frame == 1:
        assert all(p.offset == 0 for p in places)


class _Sized:
    def __init__(self, file, size):
        self.file, self.bytes = file, size
        self.seek, self.read = file.seek, file.read

    def size(self):
        return self.bytes


def test_lookup_reads_single_records(spark, tmp_path):
    rows, folder = pages_of(), f"file://{tmp_path}/archive"
    index = warc.write(spark.createDataFrame([(*r, *"abcd") for r in rows], SCHEMA).repartition(3), folder, frame=4000)
    revisits = records(index, folder).where("record_type = 'revisit'")
    found = warc.lookup(index, folder, revisits.select(F.col("refers_to").alias("record_id")))
    have = {r.record_id: r for r in found.collect()}
    for r in revisits.collect():  # every revisit's payload is at the record it refers to
        other = have[r.refers_to]
        assert (other.record_type, other.payload_digest, other.payload_bytes) == ("response", r.payload_digest, r.payload_bytes)
        assert hashlib.sha256(bytes(other.payload)).hexdigest() == r.payload_digest
    assert warc.lookup(index, folder, revisits.limit(0).select("record_id")).collect() == []


def test_damage_is_found(spark, tmp_path):
    record = warc.make_record(1, "u", b"payload", "0" * 64, None)
    with pytest.raises(ValueError, match="length"):
        list(warc.parse_records(re.sub(rb"Content-Length: (\d+)", lambda m: b"Content-Length: %d" % (int(m[1]) - 1), record, count=1)))
    with pytest.raises(ValueError, match="start"):
        list(warc.parse_records(b"x" + record))


def test_edges(spark, tmp_path, edge_docs, edge_rows, no_docs):
    folder = str(tmp_path / "edges")
    index = warc.write(edge_docs, folder, key="doc_id", url="source", payload="text")
    got = [(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.other) for r in records(index, folder, payloads=False).collect()]
    assert sorted(got, key=str) == brute([(d, None, t) for d, t, *_ in edge_rows])
    empty = warc.write(no_docs, folder, key="doc_id", url="source", payload="text")
    assert empty.collect() == [] and warc.read(empty, folder).collect() == []


def test_keys_of_other_types(spark, tmp_path):
    pages = spark.createDataFrame([("a b/<>\r\n%é+", "u", "x" * 300), ("", "u", "x" * 300), (None, "u", "y")], "page_id string, url string, html string")
    index = warc.write(pages, str(tmp_path))
    got = warc.read(index, str(tmp_path)).select(warc.key_column(F.col("record_id")).alias("k"), warc.key_column(F.col("refers_to")).alias("o")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a b/<>\r\n%é+", ""), ("", None), (None, None)], key=str)
