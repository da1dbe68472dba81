"""DuckDB SQL that must give the same rows as the corpus queries."""

from __future__ import annotations

from caresieve.llm import mixing, quality, sharding

_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

_OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
u AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 7) AS g FROM u),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, sum(least(8, coalesce(nx - i, 8))) AS n_repeat FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(ls) AS BIGINT) AS n_lines,
  CAST(len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
  CAST(len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS BIGINT) AS n_letter_words,
  CAST(len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•·]'))) AS BIGINT) AS n_bullet_lines,
  CAST(len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
q AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  coalesce(word_chars / nullif(n_words, 0), 0) AS v2, coalesce(n_symbols / nullif(word_chars, 0), 0) AS v3,
  coalesce(n_stop_words / nullif(n_words, 0), 0) AS v4, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS v5,
  coalesce(n_bullet_lines / nullif(n_lines, 0), 0) AS v6, coalesce(n_ellipsis_lines / nullif(n_lines, 0), 0) AS v7,
  coalesce(n_repeat_words / nullif(n_words, 0), 0) AS v8, coalesce(n_letter_words / nullif(n_words, 0), 0) AS v9 FROM m),
f AS (SELECT *, concat_ws(',', {{rules}}) AS failed_rules FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_letter_words, n_bullet_lines, n_ellipsis_lines,
  base_failed, failed_rules, NOT base_failed AND failed_rules = '' AS kept FROM f
"""
_VALUES = {"n_words": "n_words", "mean_word_chars": "v2", "symbol_ratio": "v3", "stop_word_ratio": "v4", "dup_line_ratio": "v5", "bullet_line_ratio": "v6", "ellipsis_line_ratio": "v7", "repeat_word_ratio": "v8", "letter_word_ratio": "v9"}


def _rule(r: quality.Rule) -> str:
    tests = [f"{_VALUES[r.metric]} < {r.low}"] * (r.low is not None) + [f"{_VALUES[r.metric]} > {r.high}"] * (r.high is not None)
    return f"CASE WHEN {' OR '.join(tests)} THEN '{r.metric}' END"


_OP3 = r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, g.first IS NOT NULL AND k.doc_id <> g.first AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

_OP4 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM r
"""

# CRC-32 from its own 256-entry table, a byte at a time
_OP5 = rf"""
WITH bits AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, CAST(b AS BIGINT))) AS t),
d AS (SELECT doc_id, coalesce('=' || source, '-') AS stratum, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, stratum, len(h) // 2 + 1 AS size, list_transform(range(1, len(h) + 1, 2), lambda i: CAST('0x' || h[i:i+1] AS BIGINT)) AS bs, t FROM d, bits),
x AS (SELECT doc_id, stratum, size, xor(list_reduce(bs, lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc FROM c),
e AS (SELECT *, md5('{sharding.SEED}:' || coalesce('=' || doc_id, '-') || ':' || size || ':' || crc) AS key FROM x),
r AS (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, size, crc) - 1 + CAST('0x' || substr(md5('{sharding.SEED}:' || stratum), 1, 13) AS BIGINT) / 4503599627370496.0) / count(*) OVER (PARTITION BY stratum) AS share FROM e),
g AS (SELECT *, row_number() OVER (ORDER BY share, key, doc_id, size, crc) - 1 AS pos, count(*) OVER () AS n FROM r),
s AS (SELECT *, CAST(pos * {sharding.SHARDS} // n AS INTEGER) AS shard FROM g)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, shard, CAST(pos - (shard * n + {sharding.SHARDS - 1}) // {sharding.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

_OP7 = f"""
WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM s) * pow(n, {mixing.TEMPERATURE}) / (SELECT sum(pow(n, {mixing.TEMPERATURE})) FROM s) / n AS rate FROM s),
p AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS c
  FROM r, (SELECT unnest(range(0, 200)) AS k)),
d AS (SELECT doc_id, source, text, CAST('0x' || substr(md5('{mixing.SEED}:=' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
n AS (SELECT d.doc_id, d.source, d.text, CAST(min(k) AS INTEGER) AS n_copies FROM d JOIN p ON d.source = p.source AND p.c > d.u GROUP BY ALL),
e AS (SELECT *, CAST(unnest(range(1, n_copies + 1)) AS INTEGER) AS copy_no FROM n WHERE n_copies > 0)
SELECT doc_id, source, copy_no, n_copies,
  round(CAST('0x' || substr(md5('{mixing.SEED}:order:=' || doc_id || ':' || copy_no), 1, 13) AS BIGINT) / 4503599627370496.0, 9) AS mix_key, text FROM e
"""

# every pair of a table, so for small tables only
_OP11 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept FROM embeddings e JOIN c ON e.vec_id = c.node LEFT JOIN n ON e.vec_id = n.a
"""


def _codes_round(k: int) -> str:
    """Nearest entries a{k} under the codebooks c{k}, and the codebooks c{k + 1} after them."""
    gap = " + ".join(f"(p.x[{i}] - c.x[{i}]) * (p.x[{i}] - c.x[{i}])" for i in range(1, 5))
    mean = ", ".join(f"CAST(floor(sum(p.x[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
    return f"""
a{k} AS (SELECT rid, vec_id, part, min(struct_pack(d := {gap}, e := c.e)) AS best FROM p JOIN c{k} c USING (part) GROUP BY rid, vec_id, part),
m{k} AS (SELECT p.part, a.best.e AS e, [{mean}] AS x FROM p JOIN a{k} a ON p.rid = a.rid AND p.part = a.part GROUP BY p.part, a.best.e),
c{k + 1} AS (SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON c.part = m.part AND c.e = m.e),"""


# vectors of 64 components, so parts of 4
_OP12 = f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, vec_id, s AS part, q[4 * s + 1 : 4 * s + 4] AS x FROM v, (SELECT unnest(range(16)) AS s)),
f AS (SELECT rid, row_number() OVER (ORDER BY vec_id, q) - 1 AS e FROM v),
c0 AS (SELECT p.part, f.e, p.x FROM p JOIN f USING (rid) WHERE f.e < 64),
{_codes_round(0)}{_codes_round(1)}{_codes_round(2).rsplit("m2 AS", 1)[0]}
r AS (SELECT rid, vec_id, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a2 GROUP BY rid, vec_id),
l AS (SELECT r.*, v.label FROM r JOIN v USING (rid)),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) AS h FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM l, b
"""

# near words meet by what is left without one code point, or with one masked
_OP13 = r"""
WITH bits AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, CAST(b AS BIGINT))) AS t),
r AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL),
k AS (SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS h FROM r WHERE length(w) >= 5),
y AS (SELECT w, n, list_transform(range(1, len(h) + 1, 2), lambda i: CAST('0x' || h[i:i+1] AS BIGINT)) AS bs FROM k),
c AS (SELECT w, n, xor(list_reduce(bs, lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM y, bits),
d AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM c),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
g AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT DISTINCT a.word AS a, b.word AS b FROM g a JOIN g b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.less, g.word FROM g JOIN v ON g.less = v.word UNION SELECT g.word, g.less FROM g JOIN v ON g.less = v.word),
s AS (SELECT e.a AS word, count(*) AS n_near, min(struct_pack(less := -v.n, w := encode(v.word), word := v.word)) AS best FROM e JOIN v ON e.b = v.word GROUP BY e.a),
f AS (SELECT v.word, v.n, coalesce(s.n_near, 0) AS n_near, CASE WHEN -s.best.less >= 2 * v.n THEN s.best.word END AS form, CASE WHEN -s.best.less >= 2 * v.n THEN -s.best.less END AS form_n FROM v LEFT JOIN s ON v.word = s.word)
"""
_OP13 = (
    "WITH RECURSIVE"
    + _OP13.strip().removeprefix("WITH")
    + """,
z AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT z.word, f.word, f.form FROM z JOIN f ON z.next = f.word)
SELECT f.word, f.form, z.root, f.n, f.n_near, CAST(f.form_n AS BIGINT) AS form_n FROM f JOIN z ON f.word = z.word WHERE z.next IS NULL
"""
)

ORACLE = {
    "op1_quality_rules": _OP1.replace("{rules}", ", ".join(_rule(r) for r in quality.RULES)),
    "op3_line_dedup": _OP3,
    "op4_exact_dedup": _OP4,
    "op5_sharding": _OP5,
    "op7_source_mixing": _OP7,
    "op11_vector_dedup": _OP11,
    "op12_vector_codes": _OP12,
    "op13_spelling_variants": _OP13,
}
