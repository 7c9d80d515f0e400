"""The registered queries of this subpackage, one per operator, and their SQL.

Every query applies its operator with production parameters to its whole table
and derives the columns of its contract from the operator's own output.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (embedding_index, html_text, line_dedup, merkle, mixing, ngram_join, pii_surrogates, quality_rules,
               sentence_pieces, suffix_repeats, token_align, token_counts, toxicity)
from .common import stored, table

try:
    from public_tokenizers import path as tokenizer_file
except ImportError:  # another place of the files can be given as TOKENIZER_DIR
    def tokenizer_file(name: str) -> str:
        return os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), name)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return add


@_query("op1_pii_surrogates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The key that drives the surrogates is a secret of the deployment.
    key = os.environ.get("MARTKIT_PII_KEY", "corpus")
    return pii_surrogates.with_surrogates(table(spark, sf_dir, "documents"), key,
                                          count_col="n_entities").select("doc_id", "text", "n_entities")


@_query("op2_sentence_pieces")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trips(table(spark, sf_dir, "documents"),
                                       tokenizer_file("piece_bpe_32k.model"))


@_query("op3_ngram_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * o >= 85 * (p.n + q.n - o)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles,
       least(w.doc_id, coalesce(min(r.y), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.x = w.doc_id GROUP BY w.doc_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), 4, 85, 100).select(
        "doc_id", "n_shingles", "component_id")


@_query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = stored(quality_rules.features(table(spark, sf_dir, "documents")), "op4-features")
    return quality_rules.judged(feats, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@_query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"),
                                       tokenizer_file("word_bpe_49k.json"))
    return counts.select("*", (F.col("n_tokens") > 2048).alias("over_limit"))


_WS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@_query("op6_line_dedup", f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, {_WS_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
  SELECT key AS common_key FROM k WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (
  SELECT doc_id, line, pos, common_key IS NOT NULL AS dropped,
         pos - sum(CASE WHEN common_key IS NULL THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY pos) AS island
  FROM k LEFT JOIN c ON key = common_key),
r AS (
  SELECT doc_id, string_agg(s, ',' ORDER BY start) AS keep_runs FROM (
    SELECT doc_id, min(pos) AS start, (min(pos) - 1) || '+' || count(*) AS s
    FROM m WHERE NOT dropped GROUP BY doc_id, island) GROUP BY doc_id)
SELECT m.doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256,
       coalesce(any_value(keep_runs), '') AS keep_runs
FROM m LEFT JOIN r ON m.doc_id = r.doc_id GROUP BY m.doc_id
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.keep_bitmaps(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1,
                                   with_text=True)
    run = lambda r: F.concat(r["start"].cast("string"), F.lit("+"), r["len"].cast("string"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
                       F.array_join(F.transform("keep", run), ",").alias("keep_runs"))


@_query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op8_html_text")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.html_text(table(spark, sf_dir, "pages"))


_OP9_SEED = 7


@_query("op9_mixing", f"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{_OP9_SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
p AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS rn
  FROM s GROUP BY source),
q AS (
  SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 3 / 2 AS total,
    coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, rn
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(w) OVER (ORDER BY 2 * source_size / w, rn
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
  FROM p),
c AS (SELECT *, (total - used) * w >= cap * left_w AS clamped FROM q),
t AS (
  SELECT source, source_size, CASE WHEN clamped THEN cap ELSE
    w * (total - sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER ())
      / sum(CASE WHEN clamped THEN 0 ELSE w END) OVER () END AS target
  FROM c),
x AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0
           THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         ('0x' || substr(h, 1, 3))::BIGINT AS u1, ('0x' || substr(h, 4, 3))::BIGINT AS u2
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
b1 AS (
  SELECT source, u1, sum(size)::DOUBLE AS sz, any_value(target - whole * source_size) AS budget,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY u1)::DOUBLE AS cum
  FROM x GROUP BY source, u1),
c1 AS (
  SELECT source, min(u1) AS at1, min_by(budget - cum + sz, u1) AS rest1
  FROM b1 WHERE cum > budget GROUP BY source),
b2 AS (
  SELECT x.source, u2, sum(size)::DOUBLE AS sz, any_value(rest1) AS budget,
         sum(sum(size)) OVER (PARTITION BY x.source ORDER BY u2)::DOUBLE AS cum
  FROM x JOIN c1 ON x.source IS NOT DISTINCT FROM c1.source AND u1 = at1 GROUP BY x.source, u2),
c2 AS (
  SELECT source, min(u2) AS at2, min_by(budget - cum + sz, u2) AS rest2, min_by(sz, u2) AS bucket_size
  FROM b2 WHERE cum > budget GROUP BY source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (whole * size + CASE WHEN at1 IS NULL THEN 0
    WHEN u1 < at1 OR (u1 = at1 AND u2 < at2) THEN size
    WHEN u1 = at1 AND u2 = at2 THEN floor(size * rest2 / bucket_size) ELSE 0 END)::BIGINT AS taken
FROM x LEFT JOIN c1 ON x.source IS NOT DISTINCT FROM c1.source
       LEFT JOIN c2 ON x.source IS NOT DISTINCT FROM c2.source
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = stored(mixing.document_sizes(table(spark, sf_dir, "documents")), "op9-sizes")
    return mixing.mix_sizes(sizes, [3, 1, 2], (3, 2), 2, _OP9_SEED).select(
        "doc_id", "size", "source_size", "target", "taken")


@_query("op10_embedding_index", """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS low FROM r GROUP BY x),
k AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT m.vec_id, coalesce(k.n, 0) AS n_links, least(m.vec_id, coalesce(c.low, m.vec_id)) AS component_id,
       m.vec_id = least(m.vec_id, coalesce(c.low, m.vec_id)) AS kept
FROM embeddings m LEFT JOIN k ON k.x = m.vec_id LEFT JOIN c ON c.x = m.vec_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_index.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


@_query("op11_suffix_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_repeats.without_repeats(table(spark, sf_dir, "documents"), width=400)
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: the polynomial division bit by bit."""
    bit = "xor(b >> 1, CASE WHEN b % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)"
    return f"""xor(4294967295::UBIGINT, list_reduce(
      list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::UBIGINT),
      lambda c, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[], lambda b, j: {bit}, xor(c, x)),
      4294967295::UBIGINT))"""


_LEAF_SQL = "sha256(" + " || ".join(
    f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END"
    for v in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"
_PARENTS_SQL = """list_transform(range(0, (len(l) + 1) // 2), lambda i:
  sha256(l[2 * i + 1] || CASE WHEN 2 * i + 2 <= len(l) THEN l[2 * i + 2] ELSE '' END))"""


@_query("op12_merkle_manifest", f"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, {_LEAF_SQL.format(n_chars="n_chars")} AS leaf,
         CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 7 = 0
           THEN {_LEAF_SQL.format(n_chars="(n_chars + 1)")} END AS tampered
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM f),
t AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS l FROM p GROUP BY lang
  UNION ALL SELECT lang, level + 1, {_PARENTS_SQL} FROM t WHERE len(l) > 1),
s AS (SELECT lang, level AS height, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
      FROM t WHERE len(l) = 1),
u AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS l FROM s
  UNION ALL SELECT level + 1, {_PARENTS_SQL} FROM u WHERE len(l) > 1),
r AS (SELECT l[1] AS root FROM u WHERE len(l) = 1),
h AS (
  SELECT p.*, s.height, s.subroot, s.place AS g FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang),
step AS (
  SELECT h.doc_id, h.leaf, h.place, h.lang, t.level, xor(h.place >> t.level, 1) < (h.place >> t.level) AS is_left,
         t.l[xor(h.place >> t.level, 1) + 1] AS sibling
  FROM h JOIN t ON h.lang IS NOT DISTINCT FROM t.lang AND t.level < h.height
  UNION ALL
  SELECT h.doc_id, h.leaf, h.place, h.lang, h.height + u.level, xor(h.g >> u.level, 1) < (h.g >> u.level),
         u.l[xor(h.g >> u.level, 1) + 1]
  FROM h JOIN u ON len(u.l) > 1),
proof AS (
  SELECT doc_id, leaf, place, lang, string_agg(sibling, '' ORDER BY level) AS siblings,
         list(coalesce(sibling, '') ORDER BY level) AS others, list(is_left ORDER BY level) AS lefts
  FROM step GROUP BY ALL),
o AS (
  SELECT h.*, coalesce(q.siblings, '') AS siblings, coalesce(q.others, []) AS others, coalesce(q.lefts, []) AS lefts
  FROM h LEFT JOIN proof q ON h.doc_id IS NOT DISTINCT FROM q.doc_id AND h.leaf = q.leaf AND h.place = q.place
    AND h.lang IS NOT DISTINCT FROM q.lang),
e AS (
  SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256,
    list_reduce(list_transform(range(1, len(others) + 1), lambda i: CASE WHEN lefts[i] THEN '<' ELSE '>' END || others[i]),
      lambda d, x: sha256(CASE WHEN x[1] = '<' THEN substr(x, 2) || d ELSE d || substr(x, 2) END),
      coalesce(tampered, leaf)) AS folded_root
  FROM o, r)
SELECT *, folded_root = root AS verified FROM e
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1)
    changed = merkle.row_digest([more if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = merkle.manifest(docs, also={"tampered": F.when(hit, changed)})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@_query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                             tokenizer_file("piece_bpe_32k.model"), digest=True)
