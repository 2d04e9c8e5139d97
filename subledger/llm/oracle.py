"""DuckDB SQL of the queries that SQL can express, by other means than the operators'."""

from __future__ import annotations

from subledger.llm import decontaminate, licenses, quality, secrets
from subledger.llm.columns import LOWER, UPPER

SPACE = r"\x20\x09-\x0D"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(rule: secrets.Rule) -> str:
    """Rows ``(rid, kind, ord, first, stop)`` of one rule."""
    p = _quoted(rule.pattern)
    order = secrets.RULES.index(rule)
    return f"""
  SELECT rid, {_quoted(rule.name)} AS kind, {order} AS ord, stop - length(found) AS first, stop
  FROM (SELECT rid, found, tested, sum(length(gap) + length(found)) OVER (PARTITION BY rid ORDER BY i) AS stop
        FROM (SELECT rid, unnest(regexp_extract_all(t, {p})) AS found, unnest(regexp_extract_all(t, {p}, {rule.group})) AS tested,
                     unnest(string_split_regex(t, {p})[1:len(regexp_extract_all(t, {p}))]) AS gap,
                     unnest(range(len(regexp_extract_all(t, {p})))) AS i
              FROM d WHERE regexp_matches(t, {p})))
  WHERE length(tested) >= {rule.least}"""


def _listed(kinds: str) -> str:
    return f"""coalesce(string_agg(kind || ':' || CAST(first AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY first, ord) FILTER ({kinds}), '')"""


BASE = "kind IN ('assign', 'access', 'hex')"
SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_spans(r) for r in secrets.RULES)}),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, {_listed(BASE)} AS base, {_listed("true")} AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""

_STOP = ", ".join(map(_quoted, quality.STOP_WORDS))


def _broken(rule: quality.Threshold) -> str:
    tests = [f"{rule.metric} < {rule.least}"] * (rule.least is not None) + [f"{rule.metric} > {rule.most}"] * (
        rule.most is not None
    )
    return f"CASE WHEN {' OR '.join(tests)} THEN '{rule.metric}' END"


QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS l
  FROM documents),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY rid),
c AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter
  FROM d LEFT JOIN r USING (rid)),
m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words::DOUBLE ELSE 0 END AS mean_word_length,
         CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words::DOUBLE ELSE 0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN n_stop::DOUBLE / n_words::DOUBLE ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_words > 0 THEN n_letter::DOUBLE / n_words::DOUBLE ELSE 0 END AS letter_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines::DOUBLE ELSE 0 END AS dup_line_ratio
  FROM c),
v AS (SELECT *, concat_ws(',', {", ".join(_broken(r) for r in quality.THRESHOLDS)}) AS failed_rules FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM v"""


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"


def url_filter(rules, sites) -> str:
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    verdict = " ".join(f"WHEN rule = '{h}{p}' THEN '{kind}'" for kind, h, p in ordered)
    return rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
c AS (
  SELECT *, regexp_replace(regexp_replace(host, '\.?(:80|:443)?$', ''), '^www\.', '') AS bare,
         CASE {rule} END AS rule
  FROM p),
u AS (SELECT *, CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+$', '') END AS canonical_url FROM c),
l AS (SELECT DISTINCT canonical_url AS c FROM u WHERE regexp_matches(host, '(^|\.)({"|".join(sites)})\.') AND canonical_url IS NOT NULL)
SELECT page_id, host, path, rule, CASE {verdict} WHEN c IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       c IS NOT NULL AS listed, canonical_url
FROM u LEFT JOIN l ON canonical_url = c"""


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') AS w FROM benchmark),
bw AS (SELECT DISTINCT id, m, array_to_string(w[i : i + m - 1], ' ') AS g
       FROM (SELECT id, w, least(len(w), {decontaminate.PASSAGE}) AS m, unnest(range(1, len(w) - least(len(w), {decontaminate.PASSAGE}) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, m, i, array_to_string(w[i : i + m - 1], ' ') AS g
       FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw))),
h AS (SELECT DISTINCT rid, id, m, i FROM dw JOIN bw USING (m, g)),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM h) GROUP BY rid),
s AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, id FROM h WHERE id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN s USING (rid)"""


def fixity(file_pages: int, damaged: tuple[int, int], lost: tuple[int, int]) -> str:
    return f"""
WITH p AS (
  SELECT page_id, coalesce(strlen(html), 0) AS size, concat_ws(chr(10), url, html) AS content FROM pages),
o AS (
  SELECT *, printf('crawl-%06d', CAST(coalesce(floor(page_id / {file_pages}), -1) AS BIGINT)) AS file FROM p),
f AS (
  SELECT *, CAST(coalesce(sum(strlen(content)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM o)
SELECT file, "offset", page_id AS record,
       CASE WHEN size % {lost[0]} = {lost[1]} THEN 'missing' ELSE 'changed' END AS kind, sha256(content) AS digest_a,
       CASE WHEN size % {lost[0]} <> {lost[1]} THEN sha256(encode(chr(0) || content[2:])) END AS digest_b
FROM f WHERE size % {lost[0]} = {lost[1]} OR size % {damaged[0]} = {damaged[1]}"""


def _canonical(text: str) -> str:
    bare = f"regexp_replace(lower({text}), '{licenses.STATEMENT}', ' \\1', 'g')"
    bare = f"regexp_replace({bare}, '{licenses.LINE_STATEMENT}', ' ', 'g')"
    bare = f"regexp_replace({bare}, '{licenses.RESERVED}', ' ', 'g')"
    out = rf"regexp_replace(trim(regexp_replace({bare}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')), '{licenses.TITLE}', '')"
    for theirs, ours in licenses.SPELLINGS:
        out = rf"regexp_replace({out}, '\b{theirs}\b', '{ours}', 'g')"
    return out


def license_scan(known=licenses.KNOWN) -> str:
    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known)
    return f"""
WITH k AS (SELECT {_canonical("t")} AS c, min(name) AS name FROM (VALUES {rows}) v(name, t) GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
e AS (SELECT rid, doc_id, {_canonical("t")} AS c FROM d),
n AS (SELECT rid, string_agg(DISTINCT name, ',' ORDER BY name) AS notices
      FROM (SELECT rid, {_canonical("line")} AS c FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)) JOIN k USING (c)
      WHERE c <> '' GROUP BY rid)
SELECT doc_id, CASE WHEN e.c <> '' THEN sha256(e.c) END AS text_digest, name AS license, coalesce(notices, '') AS notices
FROM e LEFT JOIN k ON e.c = k.c AND e.c <> '' LEFT JOIN n USING (rid)"""


def hard_negatives(scale: int, every: int, positives: int, negatives: int, window: tuple[int, int]) -> str:
    low, high = window
    return f"""
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % {every} = 0 AND a.vec_id <> b.vec_id
),
positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score
QUALIFY rank <= {negatives}
"""


def prefix_trie(family: int, shared: int) -> str:
    byte = "list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce([4294967295] || list_transform(string_split(id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda c, b: {byte}), 4294967295)"
    return f"""
WITH original AS (
    SELECT conv_id AS id,
           list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
given AS (SELECT id, turns, {crc} % {shared} AS h FROM original),
rebuilt AS (
    SELECT g.id, list_concat(coalesce(f.turns[1:g.h], []), g.turns[g.h + 1:]) AS turns
    FROM given g LEFT JOIN original f ON f.id = g.id - g.id % {family}
),
-- The path of a node is told by the digests of its turns.
coded AS (
    SELECT id, turns,
           list_transform(turns, lambda t: md5(length(t.role)::VARCHAR || ':' || t.role || t.text)) AS codes
    FROM rebuilt
),
prefixes AS (SELECT id, turns, codes, unnest(range(0, len(codes) + 1)) AS depth FROM coded),
nodes AS (
    SELECT md5(array_to_string(codes[1:depth], ',')) AS node, depth, min(id) AS conv_id, count(*) AS n_convs,
           min(CASE WHEN depth = 0 THEN NULL ELSE md5(array_to_string(codes[1:depth - 1], ',')) END) AS up,
           min(CASE WHEN depth = 0 THEN 0 ELSE length(turns[depth].text) END) AS chars,
           any_value(codes[1:depth]) AS path,
           sha256(coalesce(string_agg(id::VARCHAR, ',' ORDER BY id) FILTER (len(codes) = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY ALL
),
-- GROUP BY ALL takes the node and its depth.
children AS (SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
above AS (
    SELECT unnest(list_transform(range(0, depth + 1), lambda d: md5(array_to_string(path[1:d], ',')))) AS node,
           n_children, n_convs, chars
    FROM counted
),
sums AS (
    SELECT node, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
    FROM above GROUP BY node
)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = c.up
"""
