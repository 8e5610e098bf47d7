"""DuckDB SQL for the corpus queries that SQL can express.

Repeated bytes take SQL minutes on whole tables. Shards (a packing), token ids, XXH64 fingerprints, lattice hashing, fitted classifiers and passages retrieved by rank have no
SQL; tests compare those with brute force, a round trip or held-out labels.
"""

from __future__ import annotations

from gaugeworks.llm import licenses, phrases, rules, tries

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

BLOCK_ANCHORS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first_doc FROM g GROUP BY s),
gone AS (SELECT DISTINCT g.doc_id, g.i + k AS i FROM g JOIN f USING (s), range(13) AS r(k) WHERE first_doc < g.doc_id),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
         FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

RULE_CASCADE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
g AS (SELECT doc_id, i, words[i:i + {rules.WINDOW - 1}] AS s
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - {rules.WINDOW - 2})) AS i FROM d)),
twice AS (SELECT doc_id, s FROM g GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
            FROM g JOIN twice USING (doc_id, s), range({rules.WINDOW}) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
b AS (SELECT d.doc_id, text, words, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '{rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR n_symbols > 0.05::DOUBLE * word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words
        OR (n_dup_lines >= 3 AND 2 * n_dup_lines > n_words::DOUBLE / 8)
        OR length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) > 0.4::DOUBLE * word_chars
        OR (n_words >= 50 AND len(list_distinct(words)) < 0.1::DOUBLE * n_words)
        OR len(list_filter(range(2, n_words + 1), lambda i: words[i] = words[i - 1])) > 0.25::DOUBLE * n_words) AS kept
FROM f"""


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _license_join() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    places, labels = [], []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        at = f"list_filter(range(0, len(words) - {len(parts) - 1}), lambda i: words[i + 1:i + {len(parts)}] = {_list(parts)})"
        places.append(at)
        labels.append(f"CASE WHEN len({at}) > 0 THEN '{label}' END")
    checks = []
    for template in licenses.TEMPLATES:
        tokens = list(dict.fromkeys(template.text.split()))
        need = licenses.needed(len(tokens), licenses.THRESHOLD)
        checks.append(f"({_list(tokens)}, {need}, {len(tokens)}, '{template.label}')")
    step = licenses.BLOCK_WORDS // 2
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (SELECT doc_id, words, list_concat({", ".join(places)}) AS starts,
        list_filter([{", ".join(labels)}], lambda x: x IS NOT NULL) AS found FROM d),
t(tokens, need, n_tokens, label) AS (VALUES {", ".join(checks)}),
blocks AS (SELECT doc_id, words[k * {step} + 1:k * {step} + {licenses.BLOCK_WORDS}] AS block
    FROM (SELECT doc_id, words, unnest(range(0, greatest(0, (len(words) - {step} - 1) // {step}) + 1)) AS k FROM d)),
m AS (SELECT doc_id, list(DISTINCT label) AS more, max(n::DOUBLE / n_tokens) AS best
    FROM (SELECT doc_id, label, need, n_tokens, len(list_intersect(list_distinct(block), tokens)) AS n FROM blocks, t)
    WHERE n >= need GROUP BY doc_id)
SELECT b.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base,
    CAST(list_min(starts) AS BIGINT) AS first_word, CAST(list_max(starts) AS BIGINT) AS last_word,
    array_to_string(list_sort(list_distinct(found)), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(found, coalesce(more, [])))), ',') AS labels,
    CASE WHEN len(starts) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM b LEFT JOIN m USING (doc_id)"""


LICENSE_JOIN = _license_join()


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COLLOCATIONS = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM d),
n AS (SELECT lang, sum(len(words)) AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, words, unnest(range(1, len(words) - m + 2)) AS i FROM p, range(1, {phrases.LONGEST + 1}) AS r(m)),
f AS (SELECT lang, m, words[i:i + m - 1] AS words, count(*) AS f FROM g GROUP BY ALL HAVING f >= {phrases.LEAST}),
part AS (SELECT lang, words, f, len, unnest(range(1, m - len + 2)) AS i
    FROM (SELECT *, unnest(range(2, m)) AS len FROM f)),
inside AS (SELECT lang, words[i:i + len - 1] AS words, max(f) AS most FROM part GROUP BY ALL),
cut AS (SELECT c.lang, c.words, c.f AS a, k, l.f AS l, r.f AS r, ({phrases.SCALE}::HUGEINT * c.f) // (l.f + r.f) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
    JOIN f l ON l.lang = c.lang AND l.words = c.words[1:k]
    JOIN f r ON r.lang = c.lang AND r.words = c.words[k + 1:]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
ranked AS (SELECT lang, array_to_string(b.words, ' ') AS phrase, a, l, r, score
    FROM best b LEFT JOIN inside USING (lang, words)
    WHERE coalesce(100 * most < {phrases.COVERED_PERCENT} * a, true))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase,
    CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) QUALIFY rank <= {phrases.TOP}"""

# One step of CRC-32 per bit; a list holds each byte of the digits and seven zeros.
_CRC = """xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda x: [CAST(ord(x) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1)), CAST(4294967295 AS UBIGINT)), 4294967295)"""

CONVERSATION_TRIE = f"""
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, {_CRC} % {tries.HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
s AS (SELECT c.conv_id, 0 AS part, place, role, text FROM c
        JOIN t ON t.conv_id = c.conv_id - c.conv_id % {tries.EVERY} AND place < h
      UNION ALL SELECT conv_id, 1, place, role, text FROM c JOIN t USING (conv_id) WHERE place >= h),
q AS (SELECT conv_id, length(text) AS chars, md5(length(role) || ' ' || role || text) AS turn,
        row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM s),
p AS (SELECT conv_id, depth, chars, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM q
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
m AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
v AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS own,
        CAST(bool_and(ends) AS INT) AS leaf,
        sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
      FROM m GROUP BY path, depth),
up AS (SELECT left(path, 32 * k) AS path, sum(leaf) AS n_leaves, sum(own) AS saved_tokens
       FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM v) GROUP BY ALL),
down AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY ALL)
SELECT v.conv_id, v.depth, o.conv_id AS parent_conv_id, v.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN up USING (path) LEFT JOIN down USING (path)
LEFT JOIN v o ON v.depth > 0 AND o.path = left(v.path, 32 * (v.depth - 1))"""
