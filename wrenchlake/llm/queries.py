"""The registered queries of this subpackage, by name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.llm import bpe, decontamination, fingerprints, jaccard, lexical, lm, neighbours, packing, pii, prefixes, spans, toxicity, warc
from wrenchlake.session import ready_for_python


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready_for_python(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(column).cast("long").cast("string")) % 5


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(_table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode_documents(encoded, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _, _ = warc.archive_pages(_table(spark, sf_dir, "pages"))
    read = warc.read_archives(spark, folder, with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(_table(spark, sf_dir, "documents"), size=4, similarity=(85, 100))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = spans.remove_repeated(_table(spark, sf_dir, "documents"))
    sentences, removed = done.columns[-2:]
    return done.select("doc_id", "text", F.col(sentences).alias("n_sentences"), F.col(removed).alias("n_removed"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_fold() == 0, F.lit(False))
    model = toxicity.train(toxicity.labelled(docs, _table(spark, sf_dir, "labels")).filter(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted").hint("rebalance")


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), _fold() == 1)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.nodes(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_fingerprints": op2_fingerprints,
    "op3_pii": op3_pii,
    "op4_neighbours": op4_neighbours,
    "op5_bpe": op5_bpe,
    "op6_warc": op6_warc,
    "op7_jaccard": op7_jaccard,
    "op8_spans": op8_spans,
    "op9_toxicity": op9_toxicity,
    "op10_lm": op10_lm,
    "op11_lexical": op11_lexical,
    "op12_decontamination": op12_decontamination,
    "op13_prefixes": op13_prefixes,
}
# The queries whose results SQL can state. The others need a tokenizer, a hash that SQL lacks (crc32), a trained
# model, or are approximate; tests hold them against brute force.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SQL = {
    "op6_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS latest FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < latest THEN latest END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest""",
    "op7_jaccard": """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM split),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(y) FROM reach WHERE x = doc_id) AS component_id FROM sets""",
    "op11_lexical": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS w FROM documents),
lengths AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, sum(n) AS words FROM lengths),
items AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT DISTINCT i, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS term FROM items),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM held, total WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scores AS (
  SELECT i, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (r), total GROUP BY i, r),
ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN lengths USING (r) WHERE score > 0)
SELECT CAST(item_id AS VARCHAR) AS item_id, CAST(rank AS INTEGER) AS rank, CAST(doc_id AS BIGINT) AS doc_id, score
FROM ranked JOIN items USING (i) WHERE rank <= 10""",
    "op12_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS w FROM benchmark WHERE item_id IS NOT NULL),
b_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS win
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM b_windows),
places AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT r, s, n, item_id FROM (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM places) JOIN b_windows USING (n, win)),
words AS (SELECT r, count(DISTINCT s + k) AS n_hit FROM (SELECT r, s, unnest(range(0, n)) AS k FROM (SELECT DISTINCT r, s, n FROM hits)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256 FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op13_prefixes": """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(
    list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
      lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, k: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))),
    4294967295::UBIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h),
taken AS (SELECT c.conv_id, c.h, count(t.pos) AS n FROM convs c LEFT JOIN heads t ON t.conv_id = c.conv_id GROUP BY c.conv_id, c.h),
rebuilt AS (
  SELECT * FROM heads UNION ALL
  SELECT t.conv_id, k.n + t.pos - k.h, t.role, t.text FROM turns t JOIN taken k ON t.conv_id = k.conv_id WHERE t.pos > k.h),
ids AS (SELECT role, text, row_number() OVER () AS id FROM (SELECT DISTINCT role, text FROM rebuilt)),
lists AS (SELECT conv_id, list(id ORDER BY pos) AS way FROM rebuilt JOIN ids USING (role, text) GROUP BY conv_id),
own AS (SELECT c.conv_id, coalesce(way, []) AS way FROM convs c LEFT JOIN lists USING (conv_id)),
spots AS (SELECT conv_id, len(way) AS size, unnest(list_transform(range(0, len(way) + 1), lambda d: way[:d])) AS node FROM own),
trie AS (
  SELECT node, len(node) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = len(node)), '')) AS ends_sha256
  FROM spots GROUP BY node),
kids AS (SELECT node[:len(node) - 1] AS node, count(*) AS n_children FROM trie WHERE depth > 0 GROUP BY 1),
saving AS (
  SELECT t.node, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(length(i.text), 0) AS saved
  FROM trie t LEFT JOIN kids USING (node) LEFT JOIN ids i ON i.id = t.node[t.depth]),
below AS (
  SELECT top AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT unnest(list_transform(range(0, len(node) + 1), lambda d: node[:d])) AS top, n_children, saved FROM saving) GROUP BY top)
SELECT CAST(t.conv_id AS BIGINT) AS conv_id, CAST(t.depth AS BIGINT) AS depth, CAST(p.conv_id AS BIGINT) AS parent_conv_id, CAST(t.n_convs AS BIGINT) AS n_convs,
  CAST(s.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, t.ends_sha256
FROM trie t JOIN saving s USING (node) JOIN below USING (node) LEFT JOIN trie p ON t.depth > 0 AND p.node = t.node[:t.depth - 1]""",
}
