"""One query per operator, with production parameters over whole tables, and the SQL that checks it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparcel import session
from sparcel.llm import (
    decontaminate,
    html_text,
    langid,
    line_dedup,
    ngram_join,
    pieces,
    sharding,
    token_counts,
    topk,
    treap_index,
    turn_repair,
    warc,
    weak_rules,
)
from sparcel.llm.common import prepare, table

#: Folder of the public vocabulary files.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


#: Split pattern of the byte-level vocabularies (a fixed value that belongs to the files).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def op1_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = token_counts.read_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return token_counts.section_tokens(docs, ranks, BYTE_PATTERN).drop("name")


def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines", "n_removed", "text")


def op3_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch(spark, "warc")
    warc.write_archives(warc.archive_records(table(spark, sf_dir, "pages")), path)
    records = warc.read_archives(spark, path, keep_payload=False)
    return warc.page_captures(warc.assemble(records))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op6_recurrent_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(topk.build_index(vectors), vectors.where("vec_id % 20 = 0"), k=20)


def op8_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.Vocabulary.read(f"{TOKENIZERS}/piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, vocabulary, check=True)
    return encoded.select("doc_id", "token_ids", "n_tokens", "n_byte_tokens", "score", "round_trip")


def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"), shards=24)


def op10_nearest_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = treap_index.build_index(table(spark, sf_dir, "documents"))
    return treap_index.search(index, table(spark, sf_dir, "benchmark"), k=50)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turn_repair.repair(turn_repair.damaged(table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("conv", "conv_id")


def op13_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = weak_rules.grade(table(spark, sf_dir, "documents"))
    base = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return graded.select("doc_id", "n_words", *base, "base_failed", "kept")


_LINE_WINDOWS = """
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM {docs} WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS w
  FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS nth
    FROM windows WHERE w IS NOT NULL AND replace(replace(w, chr(10), ''), ' ', '') <> '')
  WHERE nth > 1),
covered AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) v(k)),
left_over AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL), '') AS text
  FROM lines l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos GROUP BY l.doc_id)
"""

_OP2 = "WITH " + _LINE_WINDOWS.format(docs="documents") + "SELECT doc_id, n_lines, n_removed, text FROM left_over"

_OP4 = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top IS NOT NULL AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""

_OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_OP9 = """
WITH crc AS (  -- the byte table of CRC-32 follows from its polynomial
  WITH RECURSIVE r(k, step, v) AS (
    SELECT k, 0, k FROM range(256) t(k)
    UNION ALL
    SELECT k, step + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM r WHERE step < 8)
  SELECT list(v ORDER BY k) AS tab FROM r WHERE step = 8),
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents),
summed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
    bytes, lambda c, d: xor(tab[(xor(c, d) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT))) AS text_crc32
  FROM sized, crc),
scores AS (SELECT DISTINCT doc_id, s, md5('k' || doc_id || '/' || s)[1:13] AS u FROM documents, range(25) t(s)),
best AS (
  SELECT doc_id, arg_max(s, u) FILTER (WHERE s < 24) AS shard, arg_max(s, u) AS grown_shard FROM scores GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5('k' || doc_id)[1:13], doc_id) - 1 AS slot,
       CAST(grown_shard AS INT) AS grown_shard
FROM summed JOIN best USING (doc_id)
"""

_OP11 = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
doc AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM doc),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // len))))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN doc USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

_OP12 = r"""
WITH RECURSIVE crc AS (
  WITH RECURSIVE r(k, step, v) AS (
    SELECT k, 0, k FROM range(256) t(k)
    UNION ALL
    SELECT k, step + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM r WHERE step < 8)
  SELECT list(v ORDER BY k) AS tab FROM r WHERE step = 8),
raw AS (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS cid, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'),
                        lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM conversations),
kinds AS (
  SELECT cid, turn, role, text,
         xor(4294967295, list_reduce(bytes, lambda c, d: xor(tab[(xor(c, d) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT))) % 20 AS kind
  FROM raw, crc),
rows AS (
  SELECT cid, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS k,
         substr(role, 1, 1) AS i FROM rows),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY k) > 1 AS again, lag(i) OVER (PARTITION BY cid ORDER BY k) AS before,
         NOT regexp_matches(text, '[^ 	-]') AS blank FROM placed),
turns AS (
  SELECT *, CASE WHEN blank THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' END AS fault
  FROM seen),
ins(p, q, n, roles) AS (
  VALUES (0, 0, 0, []), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []), (0, 2, 1, ['user:']), (1, 2, 1, ['user:']), (3, 2, 1, ['user:']),
         (2, 3, 1, ['assistant:']), (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])),
step(p, i, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
best(cid, k, p, b) AS (
  SELECT DISTINCT cid, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'out': CAST([] AS VARCHAR[])} FROM raw
  UNION ALL
  SELECT cid, k, q, min({'cost': cost, 'audit': audit, 'out': out}) FROM (
    SELECT t.cid, t.k, e.q, s.b.cost + 5 * ins.n + e.cost + CASE WHEN e.op <> 'D' AND t.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
           s.b.audit || repeat('I', ins.n) || e.op AS audit,
           list_concat(list_concat(s.b.out, ins.roles), CASE e.op WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text] ELSE [e.role || ':' || t.text] END) AS out
    FROM best s JOIN ins ON ins.p = s.p JOIN turns t ON t.cid = s.cid AND t.k = s.k + 1
    JOIN (
      SELECT p, q, i, 'K' AS op, 0 AS cost, '' AS role FROM step
      UNION ALL SELECT DISTINCT p, q, '*', 'R', 1, CASE q WHEN 3 THEN 'assistant' ELSE 'user' END FROM step WHERE i <> 's'
      UNION ALL SELECT p, p, '*', 'D', 2, '' FROM range(4) r(p)) e
    ON e.p = ins.q AND (e.i = '*' OR e.i = t.i) AND (e.op = 'D' OR t.fault IS NULL OR t.fault = 'truncated'))
  GROUP BY cid, k, q),
sums AS (
  SELECT c.cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(k), 0) AS n
  FROM (SELECT DISTINCT cid FROM raw) c LEFT JOIN turns USING (cid) GROUP BY c.cid),
ends AS (
  SELECT s.cid, min({'cost': b.cost + 5 * ins.n, 'audit': b.audit || repeat('I', ins.n), 'out': list_concat(b.out, ins.roles)}) AS b
  FROM best s JOIN sums ON sums.cid = s.cid AND sums.n = s.k JOIN ins ON ins.p = s.p AND ins.q IN (0, 3) GROUP BY s.cid)
SELECT any_value(conv_id) AS conv_id, any_value(gaps) AS gaps, any_value(blank) AS blank, any_value(duplicate) AS duplicate,
       any_value(truncated) AS truncated, any_value(illegal) AS illegal, any_value(b.cost) AS cost, any_value(b.audit) AS audit,
       sha256(array_to_string(any_value(b.out), chr(10))) AS repaired_sha256
FROM raw JOIN sums USING (cid) JOIN ends USING (cid) GROUP BY cid
"""

_QUERIES = {
    "op1_section_tokens": op1_section_tokens,
    "op2_line_windows": op2_line_windows,
    "op3_edit_decontamination": op3_edit_decontamination,
    "op4_warc_transactions": op4_warc_transactions,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_recurrent_language": op6_recurrent_language,
    "op7_bit_sliced_top_k": op7_bit_sliced_top_k,
    "op8_unigram_pieces": op8_unigram_pieces,
    "op9_rendezvous_shards": op9_rendezvous_shards,
    "op10_nearest_page_text": op10_nearest_page_text,
    "op11_treap_search": op11_treap_search,
    "op12_turn_repair": op12_turn_repair,
    "op13_weak_rules": op13_weak_rules,
}

ORACLES: dict[str, str] = {
    "op2_line_windows": _OP2, "op4_warc_transactions": _OP4, "op7_bit_sliced_top_k": _OP7, "op9_rendezvous_shards": _OP9,
    "op11_treap_search": _OP11,
    "op12_turn_repair": _OP12,
}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _shipped(q) for name, q in _QUERIES.items()}
