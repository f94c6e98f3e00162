"""DuckDB SQL for the queries that SQL can express.

Operators 1 and 4 are trained models, 3 adds spans of a trained model, and the order of 9 is
Spark's own hash: those are tested against plain Python versions in ``tests/llm``.
"""

from __future__ import annotations

from indexforge.llm.line_rules import LINE_SYMBOLS, MENU_SEPARATORS, MENU_WORDS, NOTICES, SYMBOLS
from indexforge.llm.text import LOWER, UPPER
from indexforge.llm.url_markov import RULES

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _class(chars: str) -> str:
    return "[" + "".join("\\" + c for c in chars) + "]"


def _visible(x: str) -> str:
    return f"length(regexp_replace({x}, '{SPACE}', '', 'g'))"


OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, w[i:i + 4] AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
          WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(w.doc_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id"""

_NORM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP5 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_NORM}') AS w
           FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(len(w), 10) AS m FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_NORM}') AS w
        FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item, m, w[k:k + m - 1] AS g FROM (
          SELECT item, m, w, unnest(range(1, len(w) - m + 2)) AS k FROM i)),
seen AS (SELECT doc_id, m, k, w[k:k + m - 1] AS g FROM (
         SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT doc_id, seen.m, k, item FROM seen JOIN win ON seen.g = win.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
            SELECT doc_id, unnest(range(k, k + m)) AS p FROM (SELECT DISTINCT doc_id, m, k FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS t
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.t, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

_PARTS = f"regexp_extract_all(lower(x), '{WORD}')"
_MENU = ", ".join(map(_text, MENU_SEPARATORS))
_ALL_MENU = ", ".join(map(_text, MENU_WORDS + MENU_SEPARATORS))
OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (SELECT doc_id, k, w[k:k + 4] AS g FROM (
          SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) > 4)),
twice AS (SELECT doc_id, k FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + 5)) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, x, {_visible('x')} AS seen FROM (
            SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE {_visible('x')} > 0),
judged AS (SELECT doc_id, x, seen,
    NOT regexp_matches(x, '[\p{{L}}\p{{N}}]')
    OR (length(x) - length(regexp_replace(x, {_text(_class(LINE_SYMBOLS))}, '', 'g'))) * 100 > seen * 10
    OR (len(list_filter({_PARTS}, lambda p: p IN ({_MENU}))) >= 3
        AND len(list_filter({_PARTS}, lambda p: p IN ({_MENU}))) * 4 >= len({_PARTS}))
    OR len(list_filter({_PARTS}, lambda p: p NOT IN ({_ALL_MENU}))) = 0
    OR regexp_matches(x, {_text(NOTICES)}) AS fails FROM lines),
per AS (SELECT doc_id, count(*) - count(DISTINCT x) AS dup, sum(CASE WHEN fails THEN 0 ELSE seen END) AS left_chars
        FROM judged GROUP BY doc_id),
base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST({_visible('t')} AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, {_text(_class(SYMBOLS))}, '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(left_chars, 0) AS left_chars
  FROM d LEFT JOIN per ON d.doc_id = per.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (word_chars - left_chars) <= 50 * word_chars AS kept FROM f"""


def _rule_case(value) -> str:
    parts = [f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}') THEN '{value(v, h, p)}'"
             for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return "CASE " + " ".join(parts) + " END"


def _op7(order: int = 4, strength: float = 2.0) -> str:
    steps = []
    for k in range(order + 1):
        last = ("1.0 / 256 AS pa, 1.0 / 256 AS pr" if not k else "b.pa, b.pr")
        join = "" if not k else f" JOIN p{k - 1} b ON substr(g, 2) = b.s"
        steps.append(f"""
g{k} AS (SELECT g, a, r, sum(a) OVER (PARTITION BY left(g, {k})) AS ca, sum(r) OVER (PARTITION BY left(g, {k})) AS cr
        FROM (SELECT right(gram, {k + 1}) AS g, sum(a) AS a, sum(r) AS r FROM grams GROUP BY ALL)),
p{k} AS (SELECT g AS s, (a + {strength} * pa) / (ca + {strength}) AS pa, (r + {strength} * pr) / (cr + {strength}) AS pr
        FROM (SELECT g, a, r, ca, cr, {last} FROM g{k}{join}))""")
    return rf"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
             FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, {_rule_case(lambda v, h, p: h + p)} AS rule, {_rule_case(lambda v, h, p: v)} AS decided,
                 repeat(chr(2), {order}) || regexp_replace(lower(host || path), '[0-9]', '0', 'g') || chr(3) AS s
          FROM parts),
chars AS (SELECT page_id, host, path, decided, substr(s, k, {order + 1}) AS gram FROM (
            SELECT *, unnest(range(1, length(s) - {order} + 1)) AS k FROM ruled)),
grams AS (SELECT gram, count(*) FILTER (WHERE decided = 'allow') AS a, count(*) FILTER (WHERE decided = 'block') AS r
          FROM chars GROUP BY gram),{",".join(steps)},
scores AS (SELECT host, path, sum(CAST(round(ln(pa / pr) * 1e6) AS BIGINT)) / count(*) / 1e6 AS score
           FROM chars JOIN p{order} ON gram = s WHERE (host, path, page_id) IN (
             SELECT host, path, min(page_id) FROM ruled GROUP BY host, path) GROUP BY host, path),
scored AS (SELECT ruled.*, score FROM ruled JOIN scores ON ruled.host = scores.host AND ruled.path = scores.path),
bins AS (SELECT floor(score / 0.01) AS b, count(*) FILTER (WHERE decided = 'allow') AS a,
                count(*) FILTER (WHERE decided = 'block') AS r FROM scored WHERE decided IS NOT NULL GROUP BY 1),
sums AS (SELECT b, lag(b) OVER o AS before, coalesce(sum(a) OVER p, 0) AS a, coalesce(sum(r) OVER p, 0) AS r,
                sum(a) OVER () AS na, sum(r) OVER () AS nr FROM bins
         WINDOW o AS (ORDER BY b), p AS (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cuts AS (SELECT r / nr + (na - a) / na AS good, (b + coalesce(before + 1, b)) / 2 * 0.01 AS cut, b FROM sums
         WHERE na > 0 AND nr > 0
         UNION ALL SELECT 1.0, (max(b) + 1) * 0.01, max(b) + 1 FROM sums WHERE na > 0 AND nr > 0 HAVING count(*) > 0),
best AS (SELECT coalesce((SELECT cut FROM cuts ORDER BY good DESC, b LIMIT 1), 0) AS cut)
SELECT page_id, host, path, rule,
       coalesce(decided, CASE WHEN score >= (SELECT cut FROM best) THEN 'allow' ELSE 'block' END) AS verdict FROM scored"""


OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
s AS (SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS g FROM (
        SELECT doc_id, x, unnest(range(0, n - 49)) AS p FROM d WHERE n >= 50)),
hit AS (SELECT doc_id, p FROM s QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
step AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM hit),
run AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END)
               OVER (PARTITION BY doc_id ORDER BY p) AS k FROM step),
runs AS (SELECT doc_id, k, min(p) AS s, max(p) + 50 AS e FROM run GROUP BY doc_id, k),
ends AS (SELECT doc_id, s, e FROM runs UNION ALL SELECT doc_id, n, n FROM d),
kept AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s, e), 0) AS b FROM ends),
out AS (SELECT kept.doc_id, string_agg(substr(x, 2 * b + 1, 2 * (s - b)), '' ORDER BY s, e) AS h
        FROM kept JOIN d ON kept.doc_id = d.doc_id GROUP BY kept.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(r.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(r.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM d JOIN out ON d.doc_id = out.doc_id
LEFT JOIN (SELECT doc_id, sum(e - s) AS removed, count(*) AS spans FROM runs GROUP BY doc_id) r ON d.doc_id = r.doc_id"""

_LINE = r"regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
OP10 = f"""
WITH d AS (SELECT *, row_number() OVER () AS r FROM documents),
l AS (SELECT r, source, k, x, {_LINE} AS y FROM (
             SELECT r, source, unnest(string_split(text, chr(10))) AS x,
                    generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d)),
n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
bad AS (SELECT l.source, y FROM l JOIN n ON l.source IS NOT DISTINCT FROM n.source WHERE y <> ''
        GROUP BY l.source, y, n HAVING count(DISTINCT r) >= 3 AND count(DISTINCT r) > CAST(0.01 AS DOUBLE) * n),
j AS (SELECT l.*, bad.y IS NOT NULL AS bad FROM l LEFT JOIN bad
      ON l.source IS NOT DISTINCT FROM bad.source AND l.y = bad.y)
SELECT d.doc_id, coalesce(o.n, 0) AS n_dropped, CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(o.t, '')) END AS kept_sha256
FROM d LEFT JOIN (
  SELECT r, count(*) FILTER (WHERE bad) AS n, string_agg(x, chr(10) ORDER BY k) FILTER (WHERE NOT bad) AS t
  FROM j GROUP BY r) o ON d.r = o.r"""

OP11 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT k, p, array_to_string(w[p:p + 34], ' ') AS g FROM (
        SELECT k, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
hit AS (SELECT k, p FROM s QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT DISTINCT k, unnest(range(p, p + 35)) AS p FROM hit),
words AS (SELECT k, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT words.k, string_agg(x, ' ' ORDER BY words.p) AS t FROM words ANTI JOIN gone
         ON words.k = gone.k AND words.p = gone.p GROUP BY words.k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.k = kept.k LEFT JOIN (SELECT k, count(*) AS n FROM gone GROUP BY k) g ON d.k = g.k"""

OP12 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, k, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
c AS (SELECT t.lang, source, t.term, count(*) AS n FROM t JOIN kept ON t.lang = kept.lang AND t.term = kept.term
      GROUP BY t.lang, source, t.term),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT g.lang, g.source, coalesce(s.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g
           LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) s
           ON g.lang = s.lang AND g.source = s.source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (kept.n + 5)) // (langs.total + 5 * v)::HUGEINT AS q
      FROM groups g JOIN kept ON g.lang = kept.lang JOIN langs ON g.lang = langs.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM groups a
          JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT p.lang, p.source, o.source AS item, sum(abs(p.p - o.p)) AS value FROM p JOIN p o
                     ON p.lang = o.lang AND p.term = o.term AND p.source <> o.source GROUP BY 1, 2, 3) x
          ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
rows AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
         UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 50"""

# crc32 of the decimal text, bit by bit: a byte is mixed in, and eight times the register is shifted
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(CAST({c} AS VARCHAR), ''), lambda z: [CAST(ascii(z) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, z: CASE WHEN z >= 0 THEN xor(a, z) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END),
    4294967295)"""
OP13 = r"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(text, '') AS x,
                  md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS name
           FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT c, list(name ORDER BY turn NULLS FIRST, name) AS xs,
                list(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) ORDER BY turn NULLS FIRST, name) AS ws, %s %% 4 AS h
         FROM t GROUP BY c),
new AS (SELECT a.c, coalesce(b.xs[1:a.h], []) || a.xs[a.h + 1:] AS xs, coalesce(b.ws[1:a.h], []) || a.ws[a.h + 1:] AS ws
        FROM conv a LEFT JOIN conv b ON b.c = a.c - a.c %% 20),
pre AS (SELECT c, xs, ws, unnest(range(0, len(xs) + 1)) AS d FROM new),
node AS (SELECT xs[1:d] AS p, d, min(c) AS conv_id, count(*) AS n, any_value(CASE WHEN d > 0 THEN ws[d] ELSE 0 END) AS words,
                coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(xs) = d), '') AS ends
         FROM pre GROUP BY xs[1:d], d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
below AS (SELECT node.p, node.d, (node.n - 1) * words AS cost, kids.n IS NULL AS leaf, unnest(range(0, d + 1)) AS up
          FROM node LEFT JOIN kids ON node.p = kids.p),
subtree AS (SELECT p[1:up] AS p, sum(cost) AS saved, count(*) FILTER (WHERE leaf) AS leaves FROM below GROUP BY 1)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, CAST(node.n AS BIGINT) AS n_convs,
       CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN subtree ON node.p = subtree.p LEFT JOIN kids ON node.p = kids.p
LEFT JOIN node above ON node.d > 0 AND above.p = node.p[1:node.d - 1]""" % _CRC.format(c="c")

ORACLE: dict[str, str] = {
    "op2_ngram_jaccard_join": OP2,
    "op5_benchmark_decontamination": OP5,
    "op6_quality_rules": OP6,
    "op7_url_filter": _op7(),
    "op8_suffix_dedup": OP8,
    "op10_line_dedup": OP10,
    "op11_doubling_dedup": OP11,
    "op12_source_divergence": OP12,
    "op13_prefix_trie": OP13,
}
