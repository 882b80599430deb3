"""Token ids in bit or byte planes.

Documents are ordered by key, encoded and put one after another. A chunk holds
whole documents, a document longer than a chunk comes alone. Inside a chunk the
ids are cut into blocks of a fixed size; a block is transposed into planes (all
lowest bits, all second bits, ..., or the same by bytes), and each plane is
compressed with zstandard. A chunk's payload is

    magic "IDPL", version, kind (0 bits, 1 bytes), planes, 0   8 bytes
    ids, ids in a block                                         2 x uint32
    size of every compressed plane, block by block              uint32 each
    the compressed planes

A file is one row per chunk of a Parquet table: part and chunk number, payload,
and the chunk index (first key, ids, checksum, and the keys and token numbers
of its documents). Spark commits the table, so that lost or repeated tasks
leave nothing behind, and the folder may be in any store.

A null text is empty and has the end id alone. Rows without a key come first;
rows that repeat a key stay, ordered by a hash of their text. An empty table
gives no chunks. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.llm.common import Recent, per_process, slices, text_of
from waypost.llm.token_counts import byte_letters
from waypost.session import materialize

MAGIC, VERSION = b"IDPL", 1
#: Ids in a block and, about, in a chunk; zstandard level; distinct words a task remembers.
BLOCK_IDS, CHUNK_IDS, LEVEL, MOST_WORDS = 1 << 16, 1 << 18, 3, 300_000
HEAD, HEAD_SIZE = "<4sBBBxII", 16

# ---- planes ----------------------------------------------------------------------------------------


def pack_ids(ids: np.ndarray, kind: str = "bit", block: int = BLOCK_IDS, level: int = LEVEL) -> bytes:
    """The payload of a chunk of unsigned 32-bit ids."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    widest = int(ids.max()).bit_length() if len(ids) else 0
    planes = widest if kind == "bit" else -(-widest // 8)
    press, sizes, body = zstandard.ZstdCompressor(level=level), [], []
    for at in range(0, len(ids), block):
        part = ids[at : at + block]
        for p in range(planes):
            if kind == "bit":
                plane = np.packbits(((part >> np.uint32(p)) & np.uint32(1)).astype(np.uint8), bitorder="little")
            else:
                plane = ((part >> np.uint32(8 * p)) & np.uint32(255)).astype(np.uint8)
            body.append(press.compress(plane.tobytes()))
            sizes.append(len(body[-1]))
    return struct.pack(HEAD, MAGIC, VERSION, kind == "byte", planes, len(ids), block) + np.array(sizes, "<u4").tobytes() + b"".join(body)


def unpack_ids(payload: bytes) -> np.ndarray:
    """The ids of a chunk's payload."""
    magic, version, bytewise, planes, n, block = struct.unpack_from(HEAD, payload)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a chunk of token ids")
    blocks = -(-n // block) if n else 0
    sizes = np.frombuffer(payload, "<u4", blocks * planes, HEAD_SIZE)
    at, k, unpress = HEAD_SIZE + sizes.nbytes, 0, zstandard.ZstdDecompressor()
    out = np.zeros(n, "<u4")
    for b in range(blocks):
        part = out[b * block : (b + 1) * block]
        for p in range(planes):
            size = int(sizes[k])
            raw = np.frombuffer(unpress.decompress(payload[at : at + size], max_output_size=block), np.uint8)
            if bytewise:
                part |= raw.astype(np.uint32) << np.uint32(8 * p)
            else:
                part |= np.unpackbits(raw, count=len(part), bitorder="little").astype(np.uint32) << np.uint32(p)
            at, k = at + size, k + 1
    return out


# ---- encoding --------------------------------------------------------------------------------------


#: Texts of these characters only are split here.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: Classes of the UTF-8 bytes of such texts, lower-cased: white space and the sign put between texts, letters, digits, other signs.
GAP, LETTER, DIGIT, SIGN = range(4)
CLASS = np.full(256, SIGN, np.uint8)
CLASS[list(b"\0\t\n\r ")], CLASS[list(b"0123456789")] = GAP, DIGIT
CLASS[ord("a") : ord("z") + 1] = CLASS[128:] = LETTER


def pretokens(data: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The tokenizer's words in the bytes of lower-cased plain texts, and where each starts.

    Its published pattern is ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``.
    """
    kind = CLASS[data]
    opens = kind != GAP
    opens[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # An apostrophe that opens a word takes the letters of an ending along; a word may open behind them.
    at = np.flatnonzero(opens & (data == ord("'")))
    after = np.append(data, np.zeros(3, np.uint8))
    one, two = after[at + 1], after[at + 2]
    short = np.isin(one, list(b"stmd"))
    long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    opens[at[short | long] + 1] = False
    behind = np.concatenate([at[short] + 2, at[long] + 3])
    behind = behind[CLASS[after[behind]] == LETTER]
    opens[behind] = True
    held = kind != GAP
    starts = np.append(np.flatnonzero(opens[held]), np.count_nonzero(held)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data[held])])
    return words, np.flatnonzero(opens)


class WordEncoder:
    """Exact ids for byte-level tokenizers that lower-case and drop white space; ids of pieces seen lately are remembered.

    Texts of plain letters, digits and signs are split together into the
    tokenizer's own words, which its model merges one by one, each distinct word
    once in a call. Other texts, and those with what may be a special string, go
    to the library between spaces and line ends, over which neither normalising
    nor splitting reaches.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.pretokens = Recent(self.merge, MOST_WORDS)
        self.words = Recent(self.whole, MOST_WORDS)

    def merge(self, pretoken: bytes) -> bytes:
        spelled = pretoken.decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(self, word: str) -> bytes:
        ids = self.library.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        plain = [bool(PLAIN.fullmatch(t)) and "<|" not in t for t in texts]
        fast = iter(self.encode_plain([t for t, p in zip(texts, plain) if p]))
        return [next(fast) if p else b"".join(map(self.words.__getitem__, t.replace("\n", " ").split(" "))) for t, p in zip(texts, plain)]

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        data = np.frombuffer("\0".join([t.lower() for t in texts]).encode(), np.uint8)
        words, at = pretokens(data)
        distinct = words.dictionary_encode()
        which = distinct.indices.to_numpy()
        ids = list(map(self.pretokens.__getitem__, distinct.dictionary.to_numpy(zero_copy_only=False).tolist()))
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        first, table = np.cumsum(size) - size, np.frombuffer(b"".join(ids), "<u4")
        count = size[which]
        ends = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        out = table[np.arange(ends[-1]) + np.repeat(first[which] - ends[:-1], count)]
        cuts = ends[np.searchsorted(at, np.flatnonzero(data == 0))]
        return [part.tobytes() for part in np.split(out, cuts)]


CHUNK_SCHEMA = "part int, chunk int, first_key {kind}, ids bigint, crc32 bigint, keys array<{kind}>, tokens array<bigint>, payload binary"


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", planes: str = "bit") -> DataFrame:
    """Encode ``docs`` in ascending key order, each with ``end_id`` appended, and write the file; its rows, read back lazily.

    ``tokenizer`` names the tokenizer's file on the executors.
    """
    schema = CHUNK_SCHEMA.format(kind=docs.schema[key].dataType.simpleString())
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("word_encoder", tokenizer), lambda: WordEncoder(tokenizer))
        part, chunk, keys, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [part, chunk, keys[0], len(ids), zlib.crc32(ids), keys, [len(h) // 4 for h in held], pack_ids(ids, planes)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for cut in slices(batch, 1):
                for k, ids in zip(cut.column(0).to_pylist(), encoder.encode(cut.column(1).to_pylist())):
                    keys.append(k)
                    held.append(ids + end)
                    size += len(held[-1])
                    if size >= 4 * CHUNK_IDS:
                        yield close()
                        chunk, keys, held, size = chunk + 1, [], [], 0
        if held:
            yield close()

    whole = text_of(text)
    rows = docs.select(F.col(key).alias("_key"), whole.alias("_text"), F.xxhash64(whole).alias("_hash"))
    ordered = rows.repartitionByRange("_key", "_hash").sortWithinPartitions("_key", "_hash").select("_key", "_text")
    return materialize(ordered.mapInArrow(run, schema))


def starts(file: DataFrame) -> DataFrame:
    """part, chunk, start: ids before each chunk. Works on the chunk index; one row per part meets in one task."""
    index = file.select("part", "chunk", "ids")
    parts = index.groupBy("part").agg(F.sum("ids").alias("n"))
    before = parts.select(F.col("part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("chunk")) - F.col("ids")
    return index.withColumn("inside", inside).join(before, "part").select("part", "chunk", (F.col("base") + F.col("inside")).alias("start"))


def read_documents(file: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens and ids (array) of each document, decoded from the file."""
    kind = file.schema["first_key"].dataType.simpleString()
    return _documents(file, key, f"`{key}` {kind}", "ids array<bigint>", lambda ids: ids.astype(np.int64).tolist(), "ids")


def read_digests(file: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens and ids_crc32 of each document, from its decoded ids."""
    kind = file.schema["first_key"].dataType.simpleString()
    return _documents(file, key, f"`{key}` {kind}", "ids_crc32 bigint", lambda ids: zlib.crc32(np.ascontiguousarray(ids)), "ids_crc32")


def _documents(file: DataFrame, key: str, key_field: str, extra: str, view, name: str) -> DataFrame:
    schema = f"part int, chunk int, {key_field}, offset bigint, n_tokens bigint, {extra}"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part, chunk, crc, keys, tokens, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpack_ids(payload)
                if zlib.crc32(ids) != crc:
                    raise ValueError(f"chunk {chunk} of part {part} is damaged")
                ends = np.cumsum(tokens)
                offsets = ends - tokens
                for lo in range(0, len(keys), 1024):
                    own = slice(lo, lo + 1024)
                    columns = [[part] * len(keys[own]), [chunk] * len(keys[own]), keys[own], offsets[own], tokens[own], [view(ids[a:b]) for a, b in zip(offsets[own], ends[own])]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    rows = file.select("part", "chunk", "crc32", "keys", "tokens", "payload").mapInArrow(run, schema)
    return rows.join(starts(file), ["part", "chunk"]).select(f"`{key}`", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", name)
