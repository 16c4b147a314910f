"""The operators' queries by name, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ebbline.llm import ann, bpe, collocations, lines, merkle, near, pieces, render, scoring, secrets, superkmers, tiling, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents"), width=4, percent=80)


ORACLE_SQL["op7_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= 80 * (len(a.s) + len(b.s) - n)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON x = doc_id
"""


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "text", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"))


@query
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(PIECES)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ids = docs.withColumn("ids", pieces.sampled_ids(F.col("text"), F.col("doc_id"), path))
    back = ids.withColumn("back", pieces.decoded(F.col("ids"), path))
    return back.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        F.col("back").eqNullSafe(F.col("text")).alias("lossless"),
    )


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_counts(table(spark, folder, "documents"), public_tokenizers.path(WORDS))


@query
def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), every=20, k=20)


ORACLE_SQL["op6_nearest_neighbours"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.language_scores(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


@query
def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = render.extract(table(spark, folder, "pages"))
    return pages.select("page_id", "text", F.length("text").alias("n_chars"))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.checked(table(spark, folder, "documents"), merkle.tampered_ids())


#: crc32 by its bitwise rule; ``below`` and ``above`` are the trees, ``climb`` folds every proof.
ORACLE_SQL["op13_merkle_manifest"] = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, text, concat(
    CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id) END,
    CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
    CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
    CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars) END) AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
sums AS (
  SELECT DISTINCT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))), lambda c, d:
      list_reduce(list_prepend(xor(c, d), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM documents WHERE doc_id IS NOT NULL),
leaves AS (
  SELECT f.doc_id, lang, sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
    CASE WHEN crc % 3 = 0 THEN sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(low), ':', low) END)) END AS claimed
  FROM fields f LEFT JOIN sums s ON f.doc_id = s.doc_id),
groups AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM documents)),
placed AS (
  SELECT doc_id, leaf, coalesce(claimed, leaf) AS claimed, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM leaves JOIN groups ON leaves.lang IS NOT DISTINCT FROM groups.lang),
below AS (
  SELECT 0 AS level, g, i, leaf AS digest, count(*) OVER (PARTITION BY g) AS m FROM placed
  UNION ALL
  SELECT level + 1, g, i // 8, sha256(string_agg(digest, '' ORDER BY i)), (m + 7) // 8 FROM below WHERE m > 1 GROUP BY level, g, i // 8, m),
subroots AS (SELECT g, digest AS subroot FROM below WHERE m = 1),
above AS (
  SELECT 0 AS level, g AS i, subroot AS digest, count(*) OVER () AS m FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)), (m + 7) // 8 FROM above WHERE m > 1 GROUP BY level, i // 8, m),
nodes AS (
  SELECT level, g, i, digest, m FROM below UNION ALL SELECT 100 + level, -1, i, digest, m FROM above),
runs AS (SELECT level, g, i // 8 AS run, list(digest ORDER BY i) AS digests FROM nodes WHERE m > 1 GROUP BY level, g, i // 8),
climb AS (
  SELECT g AS g0, i AS i0, 0 AS level, g, i, (SELECT max(m) FROM below b WHERE b.level = 0 AND b.g = placed.g) AS m, claimed AS now, '' AS proof FROM placed
  UNION ALL
  SELECT g0, i0, CASE WHEN c.m > 1 THEN c.level + 1 ELSE 100 END, CASE WHEN c.m > 1 THEN c.g ELSE -1 END,
    CASE WHEN c.m > 1 THEN c.i // 8 ELSE c.g END,
    CASE WHEN c.m > 1 THEN (c.m + 7) // 8 ELSE (SELECT count(*) FROM subroots) END,
    CASE WHEN c.m > 1 THEN sha256(concat(array_to_string(digests[:c.i % 8], ''), now, array_to_string(digests[c.i % 8 + 2:], ''))) ELSE now END,
    CASE WHEN c.m > 1 THEN concat(proof, array_to_string(digests[:c.i % 8], ''), array_to_string(digests[c.i % 8 + 2:], '')) ELSE proof END
  FROM climb c LEFT JOIN runs r ON c.m > 1 AND r.level = c.level AND r.g = c.g AND r.run = c.i // 8
  WHERE c.m > 1 OR c.g >= 0)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified
FROM placed JOIN subroots USING (g) JOIN climb c ON c.g0 = placed.g AND c.i0 = placed.i AND c.g = -1 AND c.m = 1
CROSS JOIN (SELECT digest AS root FROM above WHERE m = 1)
"""


@query
def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = superkmers.remove_repeats(table(spark, folder, "documents"), digest=True)
    return done.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


ORACLE_SQL["op12_substring_dedup"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT row_id, i, array_to_string(w[i:i + 34], ' ') AS content
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
repeated AS (SELECT content FROM windows GROUP BY content HAVING count(*) > 1),
gone AS (
  SELECT row_id, list(DISTINCT i + k) AS places
  FROM windows JOIN repeated USING (content), (SELECT unnest(range(35)) AS k) GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN places IS NULL THEN array_to_string(w, ' ')
    ELSE coalesce(array_to_string(list_filter(list_transform(w, lambda x, j: CASE WHEN list_contains(places, j) THEN NULL ELSE x END),
      lambda x: x IS NOT NULL), ' '), '') END) AS kept_sha256
FROM words LEFT JOIN gone USING (row_id)
"""


@query
def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


ORACLE_SQL["op11_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
sizes AS (SELECT unnest(range(1, 6)) AS k),
counts AS (
  SELECT lang, k, w[i:i + k - 1] AS p, CAST(count(*) AS HUGEINT) AS f FROM starts, sizes WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, k, p, f FROM counts WHERE k >= 2),
inside AS (
  SELECT DISTINCT lang, p[x:x + y - 1] AS p, f
  FROM candidates, (SELECT unnest(range(1, 5)) AS x), (SELECT unnest(range(2, 5)) AS y) WHERE y < k AND x + y - 1 <= k),
kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.p = c.p AND 100 * i.f >= 100 * c.f)),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, l.f AS l, r.f AS r, n, cut, (1000 * c.f * n) // (l.f * r.f) AS score
  FROM kept c, (SELECT unnest(range(1, 5)) AS cut), totals t, counts l, counts r
  WHERE cut < c.k AND t.lang = c.lang AND l.lang = c.lang AND l.p = c.p[:cut] AND r.lang = c.lang AND r.p = c.p[cut + 1:]),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM weakest)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
