"""DuckDB SQL of the operators that SQL can express, built from the operators' own parameters."""

from __future__ import annotations

import math

from stratum.llm.license_scan import PHRASES, TEMPLATES, THRESHOLD as CONTAINMENT, template_sets
from stratum.llm.ngram_join import N, THRESHOLD as SIMILARITY
from stratum.llm.quality_rules import MIN_ROWS, MIN_WORDS, RATIOS, SPREAD

WORD = r"[^\x20\x09-\x0D]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def quality_rules() -> str:
    """Exact counts, then the bucket sketches of each level and their fences."""
    ratios = " UNION ALL ".join(
        f"SELECT rid, lang, source, '{name}' AS ratio, CASE WHEN {bottom} > 0 THEN floor(1000 * {top} / {bottom}) ELSE 0 END::BIGINT AS v, {least} AS least FROM counts"
        for name, (top, bottom, least) in RATIOS.items())
    levels = []
    for i, keys in enumerate((("lang", "source"), ("lang",), ())):
        by = "".join(f"{k}, " for k in keys)
        levels.append(f"""
level{i} AS (
  SELECT {by}ratio, max(total) AS total, any_value(least) AS least,
         min(value) FILTER (upto >= total * 0.25) AS q1, min(value) FILTER (upto >= total * 0.5) AS q2, min(value) FILTER (upto >= total * 0.75) AS q3
  FROM (SELECT {by}ratio, least, CASE WHEN bucket < 100 THEN 10 * bucket + 9 ELSE 1000 + 100 * (bucket - 100) + 99 END AS value,
               sum(n) OVER (PARTITION BY {by}ratio) AS total, sum(n) OVER (PARTITION BY {by}ratio ORDER BY bucket) AS upto
        FROM (SELECT {by}ratio, least, bucket, count(*) AS n FROM bucketed GROUP BY ALL))
  GROUP BY {by}ratio)""")
    same = " AND ".join(f"l{{i}}.{k} IS NOT DISTINCT FROM r.{k}" for k in ("lang", "source"))
    pick = {q: f"CASE WHEN l0.total >= {MIN_ROWS} THEN l0.{q} WHEN l1.total >= {MIN_ROWS} THEN l1.{q} ELSE l2.{q} END" for q in ("q1", "q2", "q3")}
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT *, regexp_extract_all(text, '{WORD}+') AS words,
         [x for x in string_split(text, chr(10)) if regexp_matches(x, '{WORD}')] AS lines FROM docs),
places AS (SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM parts WHERE len(words) >= 3),
grams AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM places),
repeats AS (
  SELECT rid, count(DISTINCT place) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams) WHERE n > 1)
  GROUP BY rid),
counts AS (
  SELECT rid, doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM parts LEFT JOIN repeats r USING (rid)),
ratios AS ({ratios}),
bucketed AS (
  SELECT r.*, CASE WHEN v < 1000 THEN v // 10 ELSE least(1000, 100 + (v - 1000) // 100) END AS bucket
  FROM ratios r JOIN counts c USING (rid) WHERE c.n_words > 0),{','.join(levels)},
fenced AS (
  SELECT r.rid, r.ratio, r.v, {pick['q1']} AS q1, {pick['q2']} AS q2, {pick['q3']} AS q3, r.least
  FROM ratios r
  JOIN level0 l0 ON l0.ratio = r.ratio AND {same.format(i=0)}
  JOIN level1 l1 ON l1.ratio = r.ratio AND l1.lang IS NOT DISTINCT FROM r.lang
  JOIN level2 l2 ON l2.ratio = r.ratio),
outside AS (
  SELECT rid, bool_or(v > q2 + greatest({SPREAD} * (q3 - q2), least)
                      OR (ratio = 'word_length' AND v < q2 - greatest({SPREAD} * (q2 - q1), least))) AS outside
  FROM fenced GROUP BY rid),
base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(outside, FALSE) AS kept
FROM base LEFT JOIN outside USING (rid)"""


def license_scan() -> str:
    """Phrases by their places; templates by the whole sets of every line's words."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    found = " UNION ALL ".join(
        f"SELECT rid, {_text(label)} AS label, unnest([i for i in range(1, len(words) - {k - 2}) if {test}]) - 1 AS place FROM parts"
        for label, phrase in PHRASES.items()
        for k, test in [(len(phrase.split()), " AND ".join(f"words[i + {n}] = {_text(w)}" for n, w in enumerate(phrase.split())))])
    rows = ", ".join(f"({_text(label)}, [{', '.join(_text(w.decode()) for w in sorted(own))}], {math.ceil(CONTAINMENT * len(own) - 1e-9)})"
                     for label, own in template_sets(TEMPLATES))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
parts AS (SELECT *, regexp_extract_all(text, '{word}') AS words FROM docs),
found AS ({found}),
phrases AS (SELECT rid, count(*) AS n, min(place) AS lo, max(place) AS hi, list_distinct(list(label)) AS labels FROM found GROUP BY rid),
templates(label, own, need) AS (VALUES {rows}),
blocks AS (SELECT rid, list_distinct(regexp_extract_all(line, '{word}')) AS block FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)),
met AS (
  SELECT rid, list_distinct(list(label)) AS labels, max(held / len(own)) AS score
  FROM (SELECT rid, label, own, need, len(list_intersect(block, own)) AS held FROM blocks, templates WHERE len(block) >= need)
  WHERE held >= need GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_base, p.lo::BIGINT AS first_word, p.hi::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(p.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(p.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       coalesce(m.score, 0)::DOUBLE AS score
FROM parts LEFT JOIN phrases p USING (rid) LEFT JOIN met m USING (rid)"""


def ngram_join() -> str:
    """Exact similarities of the distinct gram sets that share a gram; groups by reachability."""
    gram = " || ' ' || ".join(f"words[i + {k}]" for k in range(N))
    return f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}+') AS words FROM documents),
sets AS (
  SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {N} THEN [array_to_string(words, ' ')]
         ELSE [{gram} for i in range(1, len(words) - {N - 2})] END)) AS grams FROM docs),
named AS (SELECT rid, doc_id, grams, CASE WHEN len(grams) > 0 THEN md5(array_to_string(grams, chr(1))) END AS c FROM sets),
classes AS (SELECT c, count(*) AS copies, min(doc_id) AS least, any_value(grams) AS grams FROM named WHERE c IS NOT NULL GROUP BY c),
spread AS (SELECT c, len(grams) AS size, unnest(grams) AS gram FROM classes),
edges AS (
  SELECT a.c AS x, b.c AS y FROM spread a JOIN spread b ON a.gram = b.gram AND a.c <> b.c
  GROUP BY a.c, b.c HAVING count(*) >= {SIMILARITY} * (any_value(a.size) + any_value(b.size) - count(*)) - 1e-9),
reach(x, y) AS (SELECT c, c FROM classes UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
groups AS (SELECT r.x AS c, min(k.least) AS least FROM reach r JOIN classes k ON k.c = r.y GROUP BY r.x),
links AS (SELECT e.x AS c, sum(k.copies) AS n FROM edges e JOIN classes k ON k.c = e.y GROUP BY e.x)
SELECT n.doc_id, coalesce(g.least, n.doc_id) AS class_id, coalesce(k.least, n.doc_id) AS text_class,
       (coalesce(k.copies, 1) - 1 + coalesce(l.n, 0))::BIGINT AS n_links, n.c IS NULL OR g.least = n.doc_id AS stays
FROM named n LEFT JOIN classes k USING (c) LEFT JOIN groups g USING (c) LEFT JOIN links l USING (c)"""
