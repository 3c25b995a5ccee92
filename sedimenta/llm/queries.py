"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import (
    block_labeller, byte_bpe, collocations, hnsw, line_dedup, line_quality, packing, pivots, resampling, simhash,
    suffix_dedup, token_files, toxicity,
)
from sedimenta.llm.common import read_table
from sedimenta.llm.labelled import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op5_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


@query
def op2_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digest(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op6_token_files(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    folder = token_files.encode_to_files(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.digest(spark, folder)


@query
def op9_simhash(spark, sf_dir):
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return classified(scored, toxicity.SCORE, 0.5)


def classified(scored: DataFrame, score: str, threshold: float) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), F.col(score).alias("score"),
                         (F.col(score) >= threshold).cast("int").alias("predicted"))


@query
def op8_line_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return classified(line_quality.score(docs, model), line_quality.SCORE, 0.3)


@query
def op1_pivots(spark, sf_dir):
    return pivots.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op10_hnsw(spark, sf_dir):
    return hnsw.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digest(read_table(spark, sf_dir, "documents"))


@query
def op3_block_labeller(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return block_labeller.extract(pages, block_labeller.fit(pages))


@query
def op11_line_dedup(spark, sf_dir):
    return line_dedup.digest(read_table(spark, sf_dir, "documents"))


@query
def op12_resampling(spark, sf_dir):
    return resampling.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


# At the size of the correctness run every link is found, so exact SQL gives the same rows.
ORACLE["op1_pivots"] = """WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN counted ON counted.a = vec_id JOIN least ON least.a = vec_id"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op11_line_dedup"] = """WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, line, pos, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

# crc32 is spelled out, over the distinct features, because the engine has no function for it.
ORACLE["op12_resampling"] = f"""WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, {_LOWER} AS t FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), {_LOWER} FROM benchmark),
words AS (SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
found AS (
  SELECT side, id, unnest(w) AS f FROM words
  UNION ALL SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM found) f),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i:
           16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
           lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM hexed, crc),
placed AS (SELECT side, id, bucket FROM found JOIN hashed USING (f)),
counted AS (
  SELECT b.bucket, count(p.bucket) FILTER (WHERE side = 'd') AS s, count(p.bucket) FILTER (WHERE side = 'b') AS t
  FROM range(10000) b(bucket) LEFT JOIN placed p ON p.bucket = b.bucket GROUP BY b.bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000)
         / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM counted),
weights AS (
  SELECT id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i:
           strpos('0123456789abcdef', sha256('7:' || id)[i + 1]) - 1)), lambda a, b: 16 * a + b) AS h
  FROM words LEFT JOIN weights USING (id) WHERE side = 'd'),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
  FROM noisy WHERE n_words >= 20)
SELECT n.doc_id, n_features, weight, score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank
FROM noisy n LEFT JOIN ranked r ON r.doc_id = n.doc_id"""

ORACLE["op13_collocations"] = f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
spoken AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
runs AS ({" UNION ALL ".join(
    f"SELECT lang, {n} AS m, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) "
    f"AS g FROM spoken WHERE len(w) >= {n}" for n in range(1, 5))}),
counts AS MATERIALIZED (SELECT lang, m, g, count(*) AS f FROM runs GROUP BY lang, m, g),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, g, string_split(g, ' ') AS w, f AS a FROM counts WHERE m > 1 AND f >= 30),
places AS (SELECT *, unnest(range(1, len(w))) AS k FROM candidates),
cuts AS MATERIALIZED (
  SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp FROM places),
lefts AS MATERIALIZED (SELECT c.*, f AS l FROM cuts c JOIN counts n ON n.lang = c.lang AND n.g = c.lp),
scored AS (
  SELECT c.lang, c.g, a, k, l, f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (l + f) AS BIGINT) AS score
  FROM lefts c JOIN counts n ON n.lang = c.lang AND n.g = c.rp),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
sizes AS (SELECT lang, w, a, unnest(range(2, len(w))) AS m FROM candidates WHERE len(w) > 2),
inside AS (
  SELECT lang, a, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g FROM sizes),
covers AS (SELECT lang, g, max(a) AS longer FROM inside GROUP BY lang, g),
kept AS (
  SELECT l.lang, l.g AS phrase, a, l, r, score
  FROM lowest l LEFT JOIN covers c ON c.lang = l.lang AND c.g = l.g WHERE longer IS NULL OR 100 * longer < 80 * a),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
  QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM best JOIN totals USING (lang)"""
