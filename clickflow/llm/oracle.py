"""DuckDB SQL for the corpus queries that SQL can express.

The others are held against brute force in ``tests/llm``: token ids (op2, op3), spans of decoded
layers (op5), differencing (op6), byte windows (op7), fitted rates (op10) and fingerprints (op13).
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

ORACLE["op1_exact_dedup"] = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""

ORACLE["op4_line_dedup"] = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos, len(lines) AS n FROM s),
o AS (
  SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(line) - 1 AS a,
         trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS norm
  FROM l),
p AS (SELECT doc_id, pos, n, a, string_split(regexp_replace(line, '([.!?]\s+)', '\1' || chr(30), 'g'), chr(30)) AS parts FROM o),
c AS (SELECT doc_id, pos, n, a, len(list_filter(parts, lambda x: trim(x) <> '')) AS full_parts,
             unnest(parts) AS part, unnest(range(len(parts))) AS j FROM p),
e AS (
  SELECT doc_id, pos, n, full_parts, part, j,
         a + sum(length(part)) OVER (PARTITION BY doc_id, pos ORDER BY j) - length(part) AS a,
         trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS norm
  FROM c),
u AS (
  SELECT doc_id, pos, -1 AS j, a, a + length(line) AS b, norm FROM o WHERE norm <> ''
  UNION ALL
  SELECT doc_id, pos, j, a, a + length(regexp_replace(part, '\s+$', '')), norm FROM e WHERE full_parts > 1 AND length(norm) >= 50),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, a, j) > 1 AS gone FROM u),
x AS (SELECT doc_id, pos FROM r WHERE gone AND j = -1),
g AS (SELECT * FROM r WHERE gone AND (j = -1 OR (doc_id, pos) NOT IN (SELECT (doc_id, pos) FROM x))),
k AS (
  SELECT e.doc_id, e.pos, any_value(e.n) AS n,
         string_agg(e.part, '' ORDER BY e.j) FILTER (WHERE g.j IS NULL) AS line
  FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.pos = e.pos AND g.j = e.j GROUP BY 1, 2),
t AS (
  SELECT doc_id, string_agg(coalesce(line, '') || CASE WHEN pos + 1 < n THEN chr(10) ELSE '' END, '' ORDER BY pos) AS kept_text
  FROM k ANTI JOIN x USING (doc_id, pos) GROUP BY 1),
d AS (
  SELECT doc_id, count(*) AS n_removed, CAST(sum(b - a) AS BIGINT) AS removed_chars,
         string_agg(CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a) AS removed
  FROM g GROUP BY 1)
SELECT s.doc_id, coalesce(m.n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_chars, 0) AS removed_chars, coalesce(removed, '') AS removed, coalesce(kept_text, '') AS kept_text
FROM s LEFT JOIN d USING (doc_id) LEFT JOIN t USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_units FROM u GROUP BY 1) m USING (doc_id)
"""

ORACLE["op8_ngram_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
  FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, CASE WHEN len(words) > 0 THEN 1 ELSE 0 END) + 1)) AS i
      FROM w),
sh AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM p),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
         FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.other)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.other) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""

ORACLE["op9_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_different
          FROM l WHERE regexp_matches(line, '{WORD}') GROUP BY 1),
g AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM d WHERE len(words) > 2),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS gram FROM g),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM win) WHERE k > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM rep, range(3) t(j) GROUP BY 1),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_lines - n_different, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 30 * n_words) AND NOT (100 * n_dup_lines > 40 * n_lines)
       AND NOT (100 * n_capitals > 40 * word_chars) AND word_chars BETWEEN 2 * n_words AND 15 * n_words AS kept
FROM b
"""


def lloyd_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain Lloyd rounds over all entries, a table of distances a round."""
    head = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)),
q AS MATERIALIZED (
  SELECT vec_id, i // (len(x) // {parts}) AS part, i % (len(x) // {parts}) AS pos,
         CAST(floor(x[i + 1] * {scale}) AS BIGINT) AS c
  FROM (SELECT vec_id, x, unnest(range(len(x))) AS i FROM v)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}),
b0 AS MATERIALIZED (SELECT part, entry, pos, c FROM q JOIN s USING (vec_id))"""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, part, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT vec_id, q.part, entry, sum((q.c - b.c) * (q.c - b.c))::BIGINT AS d
        FROM q JOIN b{k} b ON q.part = b.part AND q.pos = b.pos GROUP BY 1, 2, 3)
  GROUP BY 1, 2)""")
        if k < rounds:
            steps.append(f"""
b{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(n.c, b{k}.c) AS c FROM b{k} LEFT JOIN (
    SELECT q.part, best.entry AS entry, pos, CAST(floor(sum(q.c)::DOUBLE / count(*)) AS BIGINT) AS c
    FROM q JOIN a{k} USING (vec_id, part) GROUP BY 1, 2, 3) n USING (part, entry, pos))""")
    tail = f"""
r AS (SELECT vec_id, string_agg(lower(printf('%02x', best.entry)), '' ORDER BY part) AS code,
             sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY 1)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
FROM r JOIN v USING (vec_id)
"""
    return ",".join([head, *steps, tail])


ORACLE["op11_vector_codes"] = lloyd_sql()

ORACLE["op12_source_divergence"] = r"""
WITH d AS (SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  row_number() OVER () AS row FROM documents),
u AS (SELECT row, lang, source,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS used FROM u GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10),
l AS (SELECT lang, count(*) AS v, sum(used) + 2 * count(*) AS whole FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM u SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
s AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT lang, source, sum(n) AS uses FROM c GROUP BY 1, 2),
g AS (SELECT s.lang, s.source, coalesce(uses, 0) + 2 * v AS whole FROM s JOIN l USING (lang) LEFT JOIN w USING (lang, source)),
m AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
             CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // g.whole AS BIGINT) AS p,
             CAST(1 + (1000000000::HUGEINT * (used + 2)) // l.whole AS BIGINT) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
      FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
t AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM m WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM t))
SELECT * FROM r WHERE part = 'pair' OR rank <= 10
"""
