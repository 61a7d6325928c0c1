"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from barque.llm.audio import op9_audio
from barque.llm.bpe import op7_bpe
from barque.llm.filters import op12_filters
from barque.llm.html import op3_html
from barque.llm.importance import op13_resample
from barque.llm.licenses import APART, K, SHARE, TEMPLATES, op11_licenses
from barque.llm.neardup import op2_neardup
from barque.llm.packing import op4_pack
from barque.llm.quality import op5_quality
from barque.llm.repeats import op1_repeats
from barque.llm.secrets import op6_secrets
from barque.llm.topk import op10_topk
from barque.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_repeats": op1_repeats,
    "op2_neardup": op2_neardup,
    "op3_html": op3_html,
    "op4_pack": op4_pack,
    "op5_quality": op5_quality,
    "op6_secrets": op6_secrets,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_audio": op9_audio,
    "op10_topk": op10_topk,
    "op11_licenses": op11_licenses,
    "op12_filters": op12_filters,
    "op13_resample": op13_resample,
}

_TEMPLATES = ", ".join(f"({i}, '{t.label}', {t.base}, string_split('{t.words}', ' '))" for i, t in enumerate(TEMPLATES))

#: DuckDB SQL where it can express the operator on whole tables.
ORACLE_SQL: dict[str, str] = {
    "op10_topk": """
WITH good AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op11_licenses": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), templates(template, label, base, w) AS (VALUES {_TEMPLATES}),
places AS (SELECT template, label, base, len(w) AS size, p AS place, list_slice(w, p + 1, p + {K}) AS run FROM templates, LATERAL (SELECT unnest(range(len(w) - {K - 1})) AS p)),
runs AS (SELECT r, p, list_slice(w, p + 1, p + {K}) AS run FROM docs, LATERAL (SELECT unnest(range(len(w) - {K - 1})) AS p)),
votes AS (
  SELECT r, template, label, base, size, p - place AS diagonal, list_sort(list(place)) AS places FROM runs JOIN places USING (run) GROUP BY ALL
), marked AS (SELECT *, len(places) = size - {K - 1} AS whole FROM votes),
firsts AS (
  SELECT *, CAST(whole OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template, whole ORDER BY diagonal) > {APART}, true) AS INTEGER) AS first FROM marked WHERE whole OR NOT base
), grouped AS (SELECT *, sum(first) OVER (PARTITION BY r, template, whole ORDER BY diagonal) AS span FROM firsts),
spans AS (
  SELECT r, label, base, min(diagonal + places[1]) AS start,
    CAST(len(list_distinct(flatten(list_transform(flatten(list(places)), lambda p: range(p, p + {K}))))) AS DOUBLE) / greatest(size, max(diagonal + places[-1]) + {K} - min(diagonal + places[1])) AS share
  FROM grouped GROUP BY r, template, label, base, size, whole, span HAVING share >= {SHARE}
), found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score
  FROM spans GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN found USING (r)""",
    "op12_filters": """
WITH RECURSIVE rows AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), known AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY 1),
masks AS (
  SELECT part, doc_id, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
  FROM rows
), cells AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM masks LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
prefixes AS (
  SELECT '' AS prefix, 0 AS before, 0 AS applied, 0 AS bit, '' AS letter
  UNION ALL
  SELECT prefix || l.letter, applied, applied | l.bit, l.bit, l.letter FROM prefixes JOIN letters l ON applied & l.bit = 0
), metrics AS (
  SELECT part, prefix, letter, length(prefix) AS step, sum(n) FILTER (mask & applied = 0) AS kept, sum(n) FILTER (mask & p.bit <> 0 AND mask & before = 0) AS removed,
    sum(n) FILTER (mask & p.bit <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (mask = p.bit) AS unique_fails,
    sum(good) FILTER (mask & p.bit <> 0 AND mask & before = 0) AS good_lost, sum(toxic) FILTER (mask & p.bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM prefixes p, cells WHERE prefix <> '' GROUP BY ALL
), orders AS (SELECT p.prefix AS filter_order, s.step FROM prefixes p, range(1, 6) s(step) WHERE length(p.prefix) = 5),
every AS (SELECT m.*, o.filter_order FROM orders o JOIN metrics m ON m.prefix = left(o.filter_order, o.step::INT)),
shapley AS (SELECT part, letter, sum(coalesce(removed, 0)) AS shapley FROM every GROUP BY 1, 2)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM every JOIN shapley USING (part, letter)""",
}
