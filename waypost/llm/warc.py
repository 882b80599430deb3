"""WARC archives in seekable Zstandard bundles.

Each row becomes one record. Of the rows with equal payloads of at least LEAST
bytes, those with the smallest key are responses and the others are revisits
that refer to it; all smaller payloads are responses. A bundle is a file of
independent Zstandard frames. A frame holds whole records, about FRAME bytes of
them or one longer record; a seek table in a skippable frame (the public
seekable format) ends the file, so that any Zstandard reader unpacks a bundle
as a whole and ours reads single frames. The index maps each record's
identifier to its bundle, frame, and place in the unpacked frame.

Bundles are written by tasks to new names in the shared folder, through the
file system that its address names. The index is a table that Spark commits; it
names only bundles of tasks that ended, so that a lost or repeated task leaves
at most a file that nothing refers to.

Payloads meet their first key by a join on the digest. Digests that more than
one row in HOT_SHARE carries are at most HOT_SHARE in number; these are
broadcast, so that no join key holds more than that share of the rows.

A null payload is empty. Rows that repeat a key are records with the same
identifier, all of them in the index; where they have equal payloads and the
smallest key, all are responses. A null key has the identifier ``urn:nokey``, is
never referred to, and among payloads without any other key all are responses.
A null address becomes ``urn:none``. An empty table gives empty archives. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.llm.common import slices, text_of
from waypost.session import materialize, scratch_path

#: Bytes of the smallest payload that is stored once; unpacked bytes of a frame and packed bytes of a bundle, about; level.
LEAST, FRAME, BUNDLE, LEVEL = 100, 1 << 20, 256 << 20, 3
#: A digest of more than one row in so many is sent to all tasks.
HOT_SHARE = 4_096
#: Frames read by one task, about.
READ_FRAMES = 64
#: Fixed values of the seekable format: magic numbers of a skippable frame and of the table, its head, entry and foot.
SKIPPABLE, SEEKABLE, ENTRY, FOOT = 0x184D2A5E, 0x8F92EAB1, "<II", "<IBI"
#: Fixed values of the archive format.
VERSION, PROFILE, DATE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "1970-01-01T00:00:00Z"

# ---- records -----------------------------------------------------------------------------------------


def record_id(key) -> str:
    return "urn:nokey" if key is None else "urn:row:" + quote(str(key), safe="")


def key_of(identifier: str | None) -> str | None:
    return unquote(identifier[len("urn:row:") :]) if identifier and identifier.startswith("urn:row:") else None


def key_column(identifier: Column) -> Column:
    """The key in an identifier, as text; null if it has none."""
    return F.when(identifier.startswith("urn:row:"), F.url_decode(F.replace(F.substring(identifier, 9, 1 << 30), F.lit("+"), F.lit("%2B"))))


def make_record(key, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A response with its payload, or a revisit with the head of the response only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # Addresses come with anything in them; what would end a line or a field is escaped.
    target = "urn:none" if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")
    head = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(key)}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers_to)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(raw: bytes) -> Iterator[tuple[int, int, dict, dict, bytes]]:
    """Offset, length, WARC fields, HTTP fields (lower-case names) and payload of each record in a frame."""
    at = 0
    while at < len(raw):
        body = raw.index(b"\r\n\r\n", at) + 4
        fields = _fields(raw[at : body - 4], VERSION)
        end = body + int(fields["content-length"])
        if raw[end : end + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        payload = raw.index(b"\r\n\r\n", body, end) + 4
        yield at, end + 4 - at, fields, _fields(raw[body : payload - 4], "HTTP/1.1 "), raw[payload:end]
        at = end + 4


def _fields(head: bytes, first: str) -> dict:
    line, *others = head.decode().split("\r\n")
    if not line.startswith(first):
        raise ValueError(f"not the start of a record: {line[:40]}")
    return {name.lower(): value.strip() for name, value in (other.split(":", 1) for other in others)}


# ---- bundles -----------------------------------------------------------------------------------------


def file_system(folder: str):
    """The file system of an address and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", folder) else os.path.abspath(folder))


class Bundle:
    """A bundle that is being written."""

    def __init__(self, folder: str, level: int = LEVEL):
        self.name, self.sizes, self.bytes = f"bundle-{uuid.uuid4().hex}.warc.zst", [], 0
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        self.out, self.press = system.open_output_stream(f"{path}/{self.name}", compression=None), zstandard.ZstdCompressor(level=level, write_content_size=True)

    def frame(self, raw: bytes) -> int:
        """Append an independent frame; its number."""
        packed = self.press.compress(raw)
        self.out.write(packed)
        self.sizes.append((len(packed), len(raw)))
        self.bytes += len(packed)
        return len(self.sizes) - 1

    def close(self) -> None:
        table = b"".join(struct.pack(ENTRY, *s) for s in self.sizes) + struct.pack(FOOT, len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """Offset, packed and unpacked size of each frame of an open bundle, from its footer."""
    size, foot = file.size(), struct.calcsize(FOOT)
    file.seek(size - foot)
    n, kind, magic = struct.unpack(FOOT, file.read(foot))
    if magic != SEEKABLE or kind:
        raise ValueError("not a seekable bundle")
    table = n * struct.calcsize(ENTRY)
    file.seek(size - foot - table - 8)
    magic, length = struct.unpack("<II", file.read(8))
    if magic != SKIPPABLE or length != table + foot:
        raise ValueError("the seek table is damaged")
    out, at = [], 0
    for packed, unpacked in struct.iter_unpack(ENTRY, file.read(table)):
        out.append((at, packed, unpacked))
        at += packed
    return out


def read_frame(file, offset: int, packed: int, unpacked: int) -> bytes:
    file.seek(offset)
    return zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=unpacked)


# ---- writing -----------------------------------------------------------------------------------------


def first_keys(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """``rows`` (key, digest, size and others) with ``first``: the smallest key of the rows with an equal digest, null for small payloads."""
    large = rows.where(F.col("size") >= least)
    groups = materialize(large.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL"))
    total = groups.agg(F.sum("n")).first()[0] or 0
    # Each of them holds over one row in HOT_SHARE: there are fewer than HOT_SHARE.
    hot = F.col("n") * HOT_SHARE > total
    common = groups.where(hot).select("digest", F.col("first").alias("hot_first"))
    rare = groups.where(~hot).select("digest", "first")
    marked = rows.join(F.broadcast(common), "digest", "left")
    open_ = F.col("hot_first").isNull() & (F.col("size") >= least)
    # Only rows whose digest may have a partner are dealt by it.
    rest = marked.where(open_).drop("hot_first").join(rare, "digest", "left")
    return rest.unionByName(marked.where(~open_).withColumnRenamed("hot_first", "first"))


INDEX = "record_id string, bundle string, frame int, offset bigint, length bigint"


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST, frame: int = FRAME, bundle: int = BUNDLE) -> DataFrame:
    """Write the archives into ``folder``; the index, read back: record_id, bundle, frame, offset and length in the unpacked frame."""
    body = F.encode(text_of(f"`{payload}`"), "UTF-8")
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    known = first_keys(rows, least)
    refers = F.when(F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    arrow = to_arrow_schema(T.StructType.fromDDL(INDEX))

    def run(batches):
        out, held, size, at = None, [], 0, []

        def close_frame():
            number = out.frame(b"".join(held))
            columns = [[i for i, _, _ in at], [out.name] * len(at), [number] * len(at), [o for _, o, _ in at], [n for _, _, n in at]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for cut in slices(batch, 2):
                for one, address, content, digest, other in zip(*(c.to_pylist() for c in cut.columns)):
                    record = make_record(one, address, content, digest, other)
                    if held and size + len(record) > frame:
                        yield close_frame()
                        held, size, at = [], 0, []
                        if out.bytes >= bundle:
                            out.close()
                            out = None
                    out = out or Bundle(folder)
                    at.append((record_id(one), size, len(record)))
                    held.append(record)
                    size += len(record)
        if held:
            yield close_frame()
        if out:
            out.close()

    return materialize(known.select("key", "url", "payload", "digest", refers.alias("refers")).mapInArrow(run, INDEX))


# ---- reading -----------------------------------------------------------------------------------------

FRAMES = "bundle string, frame int, offset bigint, packed bigint, unpacked bigint"
RECORDS = "record_id string, record_type string, refers_to string, url string, payload_bytes bigint, payload_digest string, payload binary"


def frames(index: DataFrame, folder: str) -> DataFrame:
    """Place and sizes of every frame, from the seek tables of the bundles that the index names."""
    arrow = to_arrow_schema(T.StructType.fromDDL(FRAMES))

    def run(batches):
        system, path = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{path}/{name}") as file:
                    found = seek_table(file)
                columns = [[name] * len(found), range(len(found)), *(zip(*found) if found else ((), (), ()))]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return index.select("bundle").distinct().mapInArrow(run, FRAMES)


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives, frame by frame. A response's length and digest are measured on its payload
    and must equal what its fields say; a revisit has those of its fields. ``payload`` is null for revisits, or for all."""
    found = frames(index, folder)
    # Frames are of about equal size; a task gets some of them, dealt by bundle and number.
    dealt = found.withColumn("run", F.expr(f"frame div {READ_FRAMES}")).repartition("bundle", "run").sortWithinPartitions("bundle", "offset")
    return _records(dealt.select("bundle", "offset", "packed", "unpacked"), folder, payloads)


def _records(places: DataFrame, folder: str, payloads: bool) -> DataFrame:
    arrow = to_arrow_schema(T.StructType.fromDDL(RECORDS))

    def view(raw: bytes):
        rows = []
        for _, _, fields, http, payload in parse_records(raw):
            revisit = fields["warc-type"] == "revisit"
            size, digest = int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
            if not revisit and (size != len(payload) or digest != hashlib.sha256(payload).hexdigest()):
                raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
            refers = fields["warc-refers-to"][1:-1] if revisit else None
            target = fields["warc-target-uri"]
            rows.append((fields["warc-record-id"][1:-1], fields["warc-type"], refers, None if target == "urn:none" else target, size, digest, payload if payloads and not revisit else None))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def run(batches):
        system, path = file_system(folder)
        name = file = None
        for batch in batches:
            for bundle, offset, packed, unpacked in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    if file:
                        file.close()
                    name, file = bundle, system.open_input_file(f"{path}/{bundle}")
                yield view(read_frame(file, offset, packed, unpacked))
        if file:
            file.close()

    return places.mapInArrow(run, RECORDS)


def lookup(index: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """The records whose identifiers are in ``wanted`` (record_id); only their frames are read, each once."""
    places = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    held = places.groupBy("bundle", F.col("frame")).agg(F.count("*").alias("n")).drop("n")
    found = held.join(frames(held, folder), ["bundle", "frame"]).repartition("bundle", "frame").sortWithinPartitions("bundle", "offset")
    records = _records(found.select("bundle", "offset", "packed", "unpacked"), folder, True)
    return records.join(wanted.select("record_id").distinct(), "record_id", "left_semi")


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return scratch_path(spark, "warc")
