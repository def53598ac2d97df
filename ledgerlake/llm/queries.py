"""The registered queries of this subpackage: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import chosenpath, divideskip, fingerprint, html, mixing, negatives, pieces, pii, quality, substringdedup, suffixdedup, tokenfile, turntrie


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digest(C.documents(spark, sf_dir))


def op2_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(C.documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substringdedup.digest(C.documents(spark, sf_dir))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.check(C.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(C.documents(spark, sf_dir))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(C.spread(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(C.documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{C.shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    tokenfile.write(C.documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    atexit.register(C.forget, spark, path)
    return tokenfile.read(spark, path)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.grouped(C.documents(spark, sf_dir), 4).select("doc_id", "n_shingles", "component_id", "kept")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divideskip.linked(C.documents(spark, sf_dir), 3).select("doc_id", "n_shingles", "component_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table.withColumn("label", moved))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_syncmer_fingerprints": op2_syncmer_fingerprints,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_personal_data": op5_personal_data,
    "op6_main_text": op6_main_text,
    "op7_source_mixing": op7_source_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_file": op9_token_file,
    "op10_near_dedup": op10_near_dedup,
    "op11_ngram_join": op11_ngram_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_trie": op13_conversation_trie,
}

# Words as runs of characters outside white space; the class is written out since DuckDB reads it alike.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM common JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y WHERE 100 * common.c >= 80 * (p.c + q.c - common.c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, comp.c AS component_id, comp.c = d.doc_id AS kept
FROM documents d JOIN comp ON comp.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_SUBSTRING_SQL = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
least AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s),
hit AS (SELECT win.doc_id, win.i FROM win JOIN least USING (s) WHERE least.d < win.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) w
  LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY w.doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, (len(w.ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_JOIN_SQL = _NEAR_SQL.replace("ws[i:i + 3]", "ws[i:i + 2]").replace("len(ws) - 3", "len(ws) - 2").replace(">= 80 *", ">= 90 *").replace(", comp.c = d.doc_id AS kept", "")

_NEGATIVES_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k
    FROM s WHERE label = own AND vec_id <> anchor_id) WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS k
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10
"""

# crc32 bit by bit: a byte comes in at every eighth step
_TRIE_SQL = r"""
WITH c AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
bits AS (
  SELECT conv_id, t, list_transform(range(0, 8 * length(conv_id::VARCHAR)), lambda i: CASE WHEN i % 8 = 0 THEN ord(substr(conv_id::VARCHAR, (i // 8 + 1)::INTEGER, 1))::BIGINT ELSE 0::BIGINT END) AS b
  FROM c),
h AS (
  SELECT conv_id, t, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda x, y: xor(xor(x, y) >> 1, (xor(x, y) & 1) * 3988292384)), 4294967295) % 4 AS h
  FROM bits),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.t, [])[1:h.h], h.t[h.h + 1:]) AS t FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, d, t[1:d] AS k, t[d].t AS last, len(t) = d AS ends FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM r)),
n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(len(regexp_extract_all(last, '[^\x20\x09-\x0D]+'))), 0) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS c FROM n WHERE d > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(kids.c, 0) AS n_children FROM n LEFT JOIN kids ON kids.d = n.d AND kids.k = n.k),
up AS (SELECT k[1:a] AS k, a AS d, (n_children = 0)::INTEGER AS leaf, (n_convs - 1) * words AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f)),
tot AS (SELECT k, d, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY k, d)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children, tot.n_leaves::BIGINT AS n_leaves, tot.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN tot ON tot.d = f.d AND tot.k = f.k LEFT JOIN f p ON p.d = f.d - 1 AND p.k = f.k[1:f.d - 1]
"""

# Bytes as pairs of hexadecimal digits, since DuckDB's texts must be UTF-8
_BYTES_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, md5(substr(h, p * 2 + 1, 400)) AS w FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM d WHERE length(h) >= 400)),
many AS (SELECT w FROM win GROUP BY w HAVING count(*) > 1),
hit AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM win WHERE w IN (SELECT w FROM many)),
run AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM hit),
span AS (SELECT doc_id, k, min(p) AS a, max(p) + 200 AS b FROM run GROUP BY doc_id, k),
edge AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
kept AS (
  SELECT e.doc_id, string_agg(substr(d.h, e.before * 2 + 1, (e.a - e.before) * 2), '' ORDER BY e.a) AS t, max(e.b) AS last, sum(e.b - e.a) AS gone, count(*) AS n
  FROM edge e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(kept.gone, 0)::BIGINT AS n_removed, coalesce(kept.n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.t || substr(d.h, kept.last * 2 + 1), d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": _BYTES_SQL,
    "op3_substring_dedup": _SUBSTRING_SQL,
    "op10_near_dedup": _NEAR_SQL,
    "op11_ngram_join": _JOIN_SQL,
    "op12_hard_negatives": _NEGATIVES_SQL,
    "op13_conversation_trie": _TRIE_SQL,
}
