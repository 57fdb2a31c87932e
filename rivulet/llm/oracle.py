"""DuckDB SQL of the queries that SQL can express (views named like the tables)."""

from __future__ import annotations

from rivulet.llm.mixing import HASH_BITS
from rivulet.llm.quality import NO_LANGUAGE, RATIOS, RULES, STOP_LANGUAGES, STOP_WORDS

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}+')"


# Texts of languages without a stop-word list, by label or by script.
_UNLISTED = (r"(lower(regexp_extract(coalesce(_q_lang, ''), '^\s*([^\s_-]*)', 1)) NOT IN (" + ", ".join(f"'{x}'" for x in STOP_LANGUAGES + NO_LANGUAGE)
             + r") OR 2 * length(regexp_replace(_q_text, '\P{Latin}+', '', 'g')) < length(regexp_replace(_q_text, '\P{L}+', '', 'g')))")


def _verdict() -> str:
    parts = []
    for r in RULES:
        part, whole = RATIOS[r.measure]
        value = f"(CASE WHEN {whole} = 0 THEN 0.0 ELSE CAST({part} AS DOUBLE) / {whole} END)"
        ok = " AND ".join([f"{value} >= CAST({r.low} AS DOUBLE)"] * (r.low is not None) + [f"{value} <= CAST({r.high} AS DOUBLE)"] * (r.high is not None))
        exempt = [f"n_words < {r.min_words}"] * bool(r.min_words) + [_UNLISTED] * r.listed
        parts.append(f"({' OR '.join([f'({ok})', *exempt])})")
    return " AND ".join(parts)


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP5 = rf"""
WITH d AS (
  SELECT doc_id, lang AS _q_lang, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i+4]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
      FROM h, unnest([0, 1, 2, 3, 4]) AS u(k) WHERE n > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, _q_lang, t AS _q_text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS _q_lines, len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS _q_stops,
         len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]\s'))) AS _q_bullets,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS _q_ellipses
  FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_verdict()} AS kept
FROM b"""

OP7 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, {HASH_BITS // 4}) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / w, encode(source) NULLS LAST) AS r FROM s),
p AS (SELECT *, (SELECT sum(source_size) FROM o) - coalesce(sum(cap) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget,
             sum(w) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM o),
level AS (SELECT r, budget, ws FROM p WHERE cap * ws > budget * w ORDER BY r LIMIT 1),
t AS (SELECT p.source, source_size,
             CASE WHEN level.r IS NULL OR p.r < level.r THEN CAST(cap AS DOUBLE)
                  ELSE CAST(level.budget AS DOUBLE) * w / level.ws END AS target FROM p LEFT JOIN level ON true),
q AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS epochs FROM t),
c AS (SELECT d.*, q.source_size, q.target, q.epochs, q.target - q.epochs * q.source_size AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY d.source, h) AS tied
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
x AS (SELECT *, upto <= rest OR (upto - tied <= rest AND upto - rest <= rest - (upto - tied)) AS more FROM c)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN more AND rest > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x"""

OP1 = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^{SPACES}+', ''), '{SPACES}+$', ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT doc_id, line, pos, key IN (SELECT key FROM f) AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

OP6 = rf"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACES}+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""

OP11 = rf"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}+') AS w FROM documents),
s AS (SELECT DISTINCT i, array_to_string(w[p:p + 3], ' ') AS g
      FROM (SELECT i, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT i, count(*) AS n FROM s GROUP BY i),
c AS (SELECT a.i AS a, b.i AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.i < b.i GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.i = a JOIN n y ON y.i = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT i, i FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a AS i, min(doc_id) AS component_id FROM r JOIN d ON d.i = r.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN m USING (i) LEFT JOIN n USING (i)"""

OP12 = rf"""
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS t,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r
           FROM conversations),
v AS (SELECT c, c - c % 20 AS b, n, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0],
                                          lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 4 AS h
      FROM (SELECT c, count(*) AS n FROM o GROUP BY c)),
x AS (SELECT v.c, o.r AS p, role, t FROM v JOIN o ON o.c = v.b AND o.r <= v.h
      UNION ALL
      SELECT v.c, least(v.h, coalesce(b.n, 0)) + o.r - v.h, role, t FROM v LEFT JOIN v b ON b.c = v.b JOIN o ON o.c = v.c AND o.r > v.h),
k AS (SELECT c, p, array_to_string(list(md5(md5(role) || md5(t))) OVER (PARTITION BY c ORDER BY p), '') AS k,
             len(regexp_extract_all(t, '{WORD}+')) AS words FROM x
      UNION ALL SELECT c, 0, '', 0 FROM v),
n AS (SELECT k, p, min(c) AS conv, count(*) AS n_convs, max(words) AS words, left(k, greatest(length(k) - 32, 0)) AS up FROM k GROUP BY k, p),
ch AS (SELECT up, count(*) AS n_children FROM n WHERE p > 0 GROUP BY up),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch ON ch.up = n.k),
anc AS (SELECT DISTINCT a.k AS a, d.k AS d FROM k a JOIN k d ON a.c = d.c AND d.p >= a.p),
roll AS (SELECT a AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved FROM anc JOIN f ON f.k = anc.d GROUP BY a),
e AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends
      FROM (SELECT c, arg_max(k, p) AS k FROM k GROUP BY c) GROUP BY k)
SELECT f.conv AS conv_id, CAST(f.p AS BIGINT) AS depth, up.conv AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM f JOIN roll USING (k) LEFT JOIN e USING (k) LEFT JOIN n up ON up.k = f.up AND f.p > 0"""

OP13 = r"""
WITH p AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x
                 FROM documents)),
s AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, unnest([1, 2, 3]) AS u(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM s GROUP BY ALL),
t AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10),
halves AS (SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest
           FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
cuts AS (SELECT h.lang, h.k, h.phrase, h.a, j, x.a AS l, y.a AS r,
                CAST((CAST(1000000 AS HUGEINT) * h.a * h.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
         FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.first JOIN f y ON y.lang = h.lang AND y.phrase = h.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT lang, phrase, max(a) AS longer
           FROM (SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase FROM c, unnest([1, 2]) AS u(i) WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inside i ON i.lang = best.lang AND i.phrase = best.phrase AND best.k = 2
         WHERE i.longer IS NULL OR 100 * i.longer < 50 * best.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN t USING (lang) WHERE rank <= 2000"""

ORACLE_SQL = {"op1_line_dedup": OP1, "op6_exact_dedup": OP6, "op5_quality_rules": OP5, "op7_mix_sources": OP7,
              "op11_minhash_near_dedup": OP11, "op12_conversation_trie": OP12, "op13_phrase_collocations": OP13}
