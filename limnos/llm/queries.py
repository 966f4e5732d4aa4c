"""The registered queries of these operators over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from limnos.llm import (
    collocations,
    decontaminate,
    licences,
    packing,
    pages,
    quality,
    repetitions,
    secrets,
    simhash,
    token_counts,
    token_files,
    urls,
    vectors,
)
from limnos.llm.shared import on_workers, table

Runner = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_itself(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(token_files.round_trip(table(spark, sf_dir, "documents"), TOKENIZER))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


def op8_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.similar_vectors(table(spark, sf_dir, "embeddings"))


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.duplicate_groups(table(spark, sf_dir, "documents")))


def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetitions.digest(repetitions.periodic_runs(repetitions.with_planted_runs(table(spark, sf_dir, "documents"))))


def runners() -> dict[str, Runner]:
    return {f.__name__: on_workers(f) for f in (op1_secret_scan, op2_licence_scan, op3_quality, op4_token_files, op5_best_fit_packing, op6_url_filter,
                                    op7_html_text, op8_vector_links, op9_simhash_groups, op10_contamination, op11_collocations,
                                    op12_token_counts, op13_periodic_runs)}


_UNIT = """
sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0)"""

_VECTORS = f"""
WITH RECURSIVE {_UNIT},
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.node WHERE r.root < l.b)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, r.root AS component_id, e.vec_id = r.root AS kept
FROM embeddings e
JOIN (SELECT node, min(root) AS root FROM reached GROUP BY node) r ON r.node = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id"""

_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_CONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, coalesce({_WORDS.format('text')}, []) AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS text
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
doc_windows AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS text FROM starts, sizes WHERE i + n - 1 <= len(w)),
met AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, text)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


_PIECES = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+')"

_COLLOCATIONS = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.k AS size, c.phrase, c.f AS a, cut, array_to_string(w[1 : cut], ' ') AS head, array_to_string(w[cut + 1 : c.k], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1) c, (SELECT unnest([1, 2]) AS cut) WHERE cut < c.k),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f), cut) AS best
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
around AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + 1], ' ') AS phrase, f FROM f, (SELECT unnest([1, 2]) AS i) WHERE k = 3)
  GROUP BY lang, phrase),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase WHERE best = 1 AND (o.f IS NULL OR 100 * o.f < 50 * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def oracles() -> dict[str, str]:
    return {"op8_vector_links": _VECTORS, "op10_contamination": _CONTAMINATION, "op11_collocations": _COLLOCATIONS}
