"""DuckDB SQL of the queries that SQL can express (views: the given tables)."""

from __future__ import annotations

from changelake.llm.collocations import COVER_PCT, MIN_COUNT, NO_LANG, SCALE, TOP
from changelake.llm.line_dedup import MIN_CHARS, MIN_DOCS
from changelake.llm.mixing import BLOCK_ROWS, PERIOD, SLOTS_EACH
from changelake.llm.quality_rules import (
    BOILERPLATE, BOILERPLATE_WORDS, MARKED_PCT, MARKED_WORD, MAX_LOST_PCT, MAX_REPEAT_PCT, MIN_SEPARATORS, MIN_WORDS, SEPARATOR_PCT, SEPARATORS,
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
PLACES = ", ".join(f"'{s}'" for s in SEPARATORS)

# One node: up to FAN_OUT sources.
MIX = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (SELECT *, row_number() OVER (ORDER BY n DESC, source NULLS LAST) - 1 AS component,
                   CAST(floor(sqrt(CAST(n AS DOUBLE)) * 1024) AS BIGINT) AS w FROM counts),
sized AS (SELECT *, count(*) OVER () AS c, sum(w) OVER () AS sum_w, (count(*) OVER () * {SLOTS_EACH} + {PERIOD - 1}) // {PERIOD} AS times FROM weights),
beyonds AS (SELECT *, greatest(CAST(period AS HUGEINT) * w - sum_w, 0) AS beyond FROM (
             SELECT *, CAST({PERIOD} * CASE WHEN times <= 1 THEN 1 ELSE 1 << length(bin(times - 1)) END AS BIGINT) AS period FROM sized)),
bases AS (SELECT *, CAST(1 + (period - c) * beyond // all_beyond AS BIGINT) AS base, (period - c) * beyond % all_beyond AS left_over
          FROM (SELECT *, CAST(sum(beyond) OVER () AS HUGEINT) AS all_beyond FROM beyonds)),
quota AS (SELECT component, source, period,
                 CAST(base + CASE WHEN row_number() OVER (ORDER BY left_over DESC, component) <= period - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS q
          FROM bases),
lists AS (SELECT list(q ORDER BY component) AS qs, max(period) AS period FROM quota),
edf(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(qs, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM lists
  UNION ALL
  SELECT t, list_transform(done, lambda d, i: CASE WHEN i = pick THEN d + 1 ELSE d END), pick FROM (
    SELECT t + 1 AS t, done, CAST(list_min(list_filter(list_transform(qs, lambda x, i:
             CASE WHEN (done[i] * period) // x <= t + 1 THEN {{'deadline': ((done[i] + 1) * period + x - 1) // x, 'i': i}} END),
             lambda y: y IS NOT NULL)).i AS BIGINT) AS pick
    FROM edf, lists WHERE t < period - 1)),
slots AS (SELECT t, pick - 1 AS component, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j FROM edf WHERE t >= 0),
numbered AS (
  SELECT d.doc_id, d.source, component, q, period,
         row_number() OVER (PARTITION BY component ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id) - 1 AS rn
  FROM documents d JOIN quota ON d.source IS NOT DISTINCT FROM quota.source)
SELECT doc_id, source, n.component, q, rn // {BLOCK_ROWS} AS block,
       (rn // {BLOCK_ROWS}) * period // q AS release, ((rn // {BLOCK_ROWS} + 1) * period + q - 1) // q AS deadline,
       ((rn // {BLOCK_ROWS}) // q) * period + t AS slot, rn % {BLOCK_ROWS} AS "offset"
FROM numbered n JOIN slots s ON s.component = n.component AND s.j = (rn // {BLOCK_ROWS}) % q
"""

RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
ws AS (SELECT rid, {WORDS.format('t')} AS ws FROM d),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM ws),
grams AS (SELECT rid, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g
          FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams WHERE g IS NOT NULL) WHERE n > 1),
repeats AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT rid, line, {WORDS.format('line')} AS ws FROM lines),
judged AS (SELECT rid, line, len(ws) AS n, len(list_filter(ws, lambda x: regexp_matches(x, '{MARKED_WORD}'))) AS marked,
                  len(list_filter(ws, lambda x: x IN ({PLACES}))) AS bars FROM lw),
failed AS (SELECT rid, line, n, n > 0 AND ((bars >= {MIN_SEPARATORS} AND 100 * bars >= {SEPARATOR_PCT} * n) OR 100 * marked >= {MARKED_PCT} * n
                  OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(line, '{BOILERPLATE}'))) AS fails FROM judged),
by_line AS (SELECT rid, coalesce(sum(n) FILTER (fails), 0) AS lost, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup
            FROM failed GROUP BY rid),
counted AS (SELECT d.rid, doc_id, CAST(len(ws.ws) AS BIGINT) AS n_words,
                   CAST(coalesce(list_sum(list_transform(ws.ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(dup AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, lost
            FROM d JOIN ws USING (rid) JOIN by_line USING (rid) LEFT JOIN repeats USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AND 100 * lost <= {MAX_LOST_PCT} * n_words AS kept
FROM counted
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper, true AS repeated FROM k WHERE length(key) >= {MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT rid) >= {MIN_DOCS}),
m AS (SELECT k.rid, k.doc_id, i, line, coalesce(repeated AND k.doc_id IS DISTINCT FROM keeper, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least USING (vec_id) LEFT JOIN links USING (vec_id)
"""

PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, n, array_to_string(ws[i : i + n - 1], ' ') AS phrase, ws[i : i + n - 1] AS words
      FROM (SELECT lang, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS n) WHERE len(ws) >= n)),
f AS (SELECT lang, n, phrase, any_value(words) AS words, count(*) AS f FROM g GROUP BY lang, n, phrase),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS total FROM f WHERE n = 1 GROUP BY lang),
cand AS (SELECT lang, n, phrase, words, f AS a FROM f WHERE n > 1 AND f >= {MIN_COUNT}),
cuts AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST({SCALE}::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
         FROM (SELECT *, unnest(range(1, n)) AS k FROM cand) c
         JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : k], ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1 : c.n], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covers AS (SELECT lang, phrase, max(f) AS longer FROM (
             SELECT lang, a AS f, unnest([array_to_string(words[1 : 2], ' '), array_to_string(words[2 : 3], ' ')]) AS phrase FROM cand WHERE n = 3) GROUP BY lang, phrase),
kept AS (SELECT s.* FROM scored s LEFT JOIN covers v ON v.lang = s.lang AND v.phrase = s.phrase WHERE coalesce(100 * longer < {COVER_PCT} * a, true))
SELECT k.lang, rank, phrase, a, l, r, total AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) k JOIN totals t ON t.lang = k.lang
WHERE rank <= {TOP}
"""

ORACLES: dict[str, str] = {
    "op2_mix_sources": MIX,
    "op5_quality_rules": RULES,
    "op9_line_dedup": LINES,
    "op10_embedding_dedup": VECTORS,
    "op12_collocations": PHRASES,
}
