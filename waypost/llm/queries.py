"""Registered queries of the text operators, over whole tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.llm import ann, bitplanes, chat, lattice, lexical, lm_scores, merkle, packing, pii, quality, simhash, token_counts, warc
from waypost.llm.common import table, text_of
from waypost.llm.registry import query
from waypost.session import materialize

# ---- 1: segmentation samples ---------------------------------------------------------------------


@query("op1_gumbel_top_k")
def gumbel_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return lattice.sample_digests(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


# ---- 2: packing ----------------------------------------------------------------------------------


@query("op2_length_buckets", packing.pack_sql("SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS n FROM documents"))
def length_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Byte-level tokens (one id per UTF-8 byte and an end id) packed into length buckets."""
    return packing.pack(table(spark, sf, "documents"), F.octet_length(text_of("text")) + 1)


# ---- 3: personal data ----------------------------------------------------------------------------


@query("op3_char_tagger")
def char_tagger(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return pii.digest(docs, pii.fit(pii.labelled_windows(docs)))


# ---- 4: language-model scores --------------------------------------------------------------------


@query("op4_cross_entropy_difference")
def cross_entropy_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against those labelled of good quality."""
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return lm_scores.score(table(spark, sf, "documents"), good)


# ---- 5: token counts -----------------------------------------------------------------------------


@query("op5_token_counts")
def token_count(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


# ---- 6: token ids --------------------------------------------------------------------------------


@query("op6_bit_planes")
def bit_planes(spark: SparkSession, sf: str) -> DataFrame:
    """All documents encoded, written in bit planes, and digested from what is read back."""
    file = bitplanes.write_ids(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return bitplanes.read_digests(file)


# ---- 7: chat formatting --------------------------------------------------------------------------

EDGE_CHAT = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]

CHAT_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, replace(replace(text, '&', '&amp;'), '<', '&lt;') AS safe,
         replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '"', '&quot;') AS safe_role,
         coalesce(lag(role) OVER w <> role, true) AS opens
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(safe) + CASE WHEN opens THEN 12 + length(safe_role) + 2 + 8 ELSE 7 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op7_chat_format", CHAT_SQL)
def chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations formatted, written, read back and compared by digests."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    edge = spark.createDataFrame(EDGE_CHAT, "conv_id bigint, turn bigint, role string, text string")
    written = materialize(chat.format_chats(turns.unionByName(edge)))
    back = chat.read_turns(F.col("formatted"))
    read = written.select("conv_id", back.alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


# ---- 8: near-duplicates --------------------------------------------------------------------------


@query("op8_covering_simhash")
def covering_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


# ---- 9: nearest neighbours -----------------------------------------------------------------------


@query("op9_stable_projections")
def stable_projections(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


# ---- 10: quality rules ---------------------------------------------------------------------------

QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM pos),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win, range(0, 3) r(k) WHERE c > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM f
"""


@query("op10_rule_cascade", QUALITY_SQL)
def rule_cascade(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.cascade(table(spark, sf, "documents"), measures=True)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept")


# ---- 11: manifest --------------------------------------------------------------------------------

MANIFEST_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf_sql(text: str) -> str:
    parts = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + "))"


#: The checksum of a key goes bit by bit over its bytes; the inverted last value has the other lowest bit.
MANIFEST_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT *, coalesce(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda s, e: xor(xor(s, e) >> 1, 3988292384 * (xor(s, e) & 1))) & 1 = 1, false) AS tampered
  FROM documents
), leaves AS (
  SELECT doc_id, source, {_leaf_sql('text')} AS leaf, {_leaf_sql("CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END")} AS claimed FROM crc
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), low(level, tree, place, n, hash) AS (
  SELECT 0, tree, place, count(*) OVER (PARTITION BY tree), leaf FROM placed
  UNION ALL
  SELECT level + 1, tree, place // 3, max(n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place)) FROM low WHERE n > 1 GROUP BY level, tree, place // 3
), high(level, tree, place, n, hash) AS (
  SELECT 0, -1, tree, count(*) OVER (), hash FROM low WHERE n = 1
  UNION ALL
  SELECT level + 1, tree, place // 3, max(n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place)) FROM high WHERE n > 1 GROUP BY level, tree, place // 3
), beside AS (
  SELECT tree, level, place, coalesce(lag(hash, 2) OVER w, '') || coalesce(lag(hash) OVER w, '') AS l, coalesce(lead(hash) OVER w, '') || coalesce(lead(hash, 2) OVER w, '') AS r
  FROM (FROM low UNION ALL FROM high) WHERE n > 1 WINDOW w AS (PARTITION BY tree, level, place // 3 ORDER BY place)
), up(doc_id, leaf, tree, level, place, proof, folded) AS (
  SELECT doc_id, leaf, tree, 0, place, '', claimed FROM placed
  UNION ALL
  SELECT doc_id, leaf, tree, level + 1, place // 3, proof || l || r, sha256(l || folded || r) FROM up JOIN beside USING (tree, level, place)
), over(doc_id, leaf, subtree, tree, level, place, proof, folded) AS (
  SELECT doc_id, leaf, up.tree, -1, 0, up.tree, proof, folded FROM up JOIN low USING (tree, level, place) WHERE n = 1
  UNION ALL
  SELECT doc_id, leaf, subtree, tree, level + 1, place // 3, proof || l || r, sha256(l || folded || r) FROM over JOIN beside USING (tree, level, place)
)
SELECT doc_id, leaf, low.hash AS subroot, high.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = high.hash AS verified
FROM over JOIN high ON high.n = 1 AND high.level = over.level JOIN low ON low.n = 1 AND low.tree = over.subtree
"""


@query("op11_octopus_multiproof", MANIFEST_SQL)
def octopus_multiproof(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's proof, folded again from a copy of which some have lost their line ends."""
    docs = table(spark, sf, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    other = merkle.leaf_hash([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in MANIFEST_COLUMNS])
    proven = merkle.manifest(docs, MANIFEST_COLUMNS, claims={"claimed": F.when(tampered, other)})
    siblings = F.array_join(F.transform("proof", lambda step: F.concat(step["left"], step["right"])), "")
    root = merkle.folded(F.coalesce("claimed", "leaf"), F.col("proof"))
    out = proven.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# ---- 12: ranked search ---------------------------------------------------------------------------

SEARCH_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d SEMI JOIN i USING (term) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n_docs),
part AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS part
  FROM tf JOIN size USING (doc_id) JOIN w USING (term), total
), s AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM i JOIN part USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query("op12_blocked_search", SEARCH_SQL)
def blocked_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# ---- 13: archives --------------------------------------------------------------------------------

ARCHIVE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""


@query("op13_seekable_warc", ARCHIVE_SQL)
def seekable_warc(spark: SparkSession, sf: str) -> DataFrame:
    """All pages written into seekable bundles, and what the bundles hold."""
    folder = warc.archive_folder(spark)
    records = warc.read(warc.write(table(spark, sf, "pages"), folder), folder, payloads=False)
    page = lambda c: warc.key_column(F.col(c)).cast("bigint")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
