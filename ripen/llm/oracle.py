"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .queries import SHARDS, URL_RULES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP1 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k FROM w, unnest(range(1, len(ws) - 18)) AS t(i)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM later, unnest(range(i, i + 20)) AS t(p)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS line
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(line, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_OP4 = f"""
WITH crc AS (
  -- the reflected polynomial's table, then one step a byte
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY n) AS steps
  FROM unnest(range(256)) AS t(n)),
d AS (SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, hex(coalesce(text, '')) AS h FROM documents),
b AS (SELECT doc_id, size, list_transform(range(size - 16), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS bytes FROM d),
s AS (SELECT doc_id, size, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bytes),
        lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]))) AS text_crc32 FROM b, crc),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS start, sum(size) OVER () AS total FROM s),
p AS (SELECT *, CAST(least({SHARDS - 1}, (2 * start + size) * {SHARDS} // (2 * total)) AS INTEGER) AS shard FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""


def _fill(level: int) -> str:
    """Water-filling of one level of the mixing tree: each node's share of its parent's budget."""
    path = ["domain", "lang", "source"][:level]
    weight = {1: "CASE WHEN domain = 'd0' THEN 2.0 ELSE 1.0 END", 2: "CASE WHEN lang = 'en' THEN 3.0 ELSE 1.0 END", 3: "1.0"}[level]
    up, names = ", ".join(path[:-1]), ", ".join(path)
    part = f"PARTITION BY {up} " if up else ""
    given = f"JOIN b{level - 1} USING ({up})" if up else "CROSS JOIN (SELECT 0.5 * sum(tokens) AS budget FROM leaf)"
    return f"""
n{level} AS (SELECT {names}, CAST({weight} AS DOUBLE) AS w, CAST(2 * sum(tokens) AS DOUBLE) AS cap FROM leaf GROUP BY {names}),
l{level} AS (SELECT n{level}.*, budget AS given,
        (budget - coalesce(sum(cap) OVER ({part}ORDER BY cap / w, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(w) OVER ({part}ORDER BY cap / w, {path[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n{level} {given}),
b{level} AS (SELECT {names}, CASE WHEN cap <= w * level THEN cap ELSE least(cap, w *
        first(CASE WHEN cap > w * level THEN level END IGNORE NULLS) OVER ({part}ORDER BY cap / w, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) END AS budget
        FROM l{level})"""


_OP5 = f"""
WITH d AS (SELECT doc_id, lang AS lang0, source AS source0, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
        coalesce('d' || (TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4), 'unknown') AS domain,
        CAST(len({_WORDS}) AS BIGINT) AS t FROM documents),
leaf AS (SELECT domain, lang, source, sum(t) AS tokens FROM d GROUP BY ALL),{_fill(1)},{_fill(2)},{_fill(3)},
plan AS (SELECT domain, lang, source, tokens, CAST(floor(budget + 1e-6) AS BIGINT) AS budget FROM b3 JOIN leaf USING (domain, lang, source)),
k AS (SELECT d.*, tokens, CAST(CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS INTEGER) AS whole, budget FROM d JOIN plan USING (domain, lang, source)),
r AS (SELECT *, budget - whole * tokens AS rest, sum(t) OVER (PARTITION BY domain, lang, source ORDER BY md5(doc_id || ':17:' || whole)
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM k)
SELECT doc_id, domain, lang0 AS lang, source0 AS source, t AS n_tokens,
       CAST(whole + CASE WHEN whole < 2 AND (rest > 0 OR tokens = 0) AND run <= rest THEN 1 ELSE 0 END AS INTEGER) AS copies
FROM r WHERE whole > 0 OR (whole < 2 AND (rest > 0 OR tokens = 0) AND run <= rest)
"""

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _rule(host: str, path: str, what: str) -> str:
    out = []
    for action, rule in sorted(URL_RULES, key=lambda r: -len(r[1])):
        h, _, p = rule.partition("/")
        out.append(f"WHEN ({host} = '{h}' OR {host} LIKE '%.{h}') AND starts_with({path}, '/{p}') THEN '{rule if what == 'rule' else action}'")
    return "CASE " + " ".join(out) + " END"


# the given pages declare no canonical links or redirects, so a class is the URLs of one bare form
_OP6 = rf"""
WITH p AS (SELECT page_id, url, contains(coalesce(url, ''), '://') AS ok,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), {_UPPER}) AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*(/[^?#]*)', 1) AS path,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\?utm_[^&]*(&|$)', '?'), '&utm_[^&]*', '', 'g'), '[?&]$', '') AS cut FROM pages),
b AS (SELECT *, CASE WHEN ok THEN regexp_extract(cut, '^.*?://') || translate(regexp_extract(cut, '://([^/?]*)', 1), {_UPPER}) || regexp_replace(cut, '^.*?://[^/?]*', '') END AS bare FROM p),
nodes AS (SELECT bare, host, path FROM b WHERE ok),
c AS (SELECT bare, bool_or({_rule('host', 'path', 'action')} = 'allow') AS allowed, bool_or({_rule('host', 'path', 'action')} = 'block') AS blocked FROM nodes GROUP BY bare)
SELECT page_id, host, path, {_rule('host', 'path', 'rule')} AS rule,
       coalesce({_rule('host', 'path', 'action')}, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM b LEFT JOIN c USING (bare)
"""

_OP8 = f"""
WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_ALNUM} AS ws FROM benchmark),
w AS (SELECT DISTINCT item, least(13, len(ws)) AS size, ws[j:j + least(13, len(ws)) - 1] AS k
      FROM i, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS t(j) WHERE len(ws) > 0),
d AS (SELECT doc_id, {_ALNUM} AS ws FROM documents),
g AS (SELECT doc_id, j, size, ws[j:j + size - 1] AS k FROM d, (SELECT DISTINCT size FROM w) AS s, unnest(range(1, len(ws) - size + 2)) AS t(j)),
h AS (SELECT doc_id, j, g.size AS size, item FROM g JOIN w ON g.k = w.k AND g.size = w.size),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(j, j + size)) AS t(p) GROUP BY doc_id),
x AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN x USING (doc_id)
"""

_OP11 = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, unnest(range(0, n - 49)) AS i, unnest(list_transform(range(0, n - 49), lambda i: substr(h, 2 * i + 1, 100))) AS k FROM d),
gone AS (SELECT doc_id, i FROM w QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
cut AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS new FROM gone),
runs AS (SELECT doc_id, i, count(*) FILTER (new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cut),
spans AS (SELECT doc_id, min(i) AS lo, max(i) + 50 AS hi FROM runs GROUP BY doc_id, k),
gaps AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM spans
         UNION ALL SELECT doc_id, coalesce(max(hi), 0), any_value(n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b) AS line FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
counts AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(line)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

# each document walks every order by itself: no masks, no cells
_OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS MATERIALIZED (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END AS failed
      FROM d LEFT JOIN marks USING (doc_id)),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || e.x || g.x AS filter_order FROM letter a, letter b, letter c, letter e, letter g
           WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
steps AS MATERIALIZED (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
          FROM orders, unnest(range(1, 6)) AS t(step)),
judged AS (SELECT part, filter_order, step, own, good, toxic, failed = own AS only_own, contains(failed, own) AS fails,
        len(list_intersect(string_split(failed, ''), string_split(before, ''))) > 0 AND before <> '' AND failed <> '' AS gone FROM f, steps),
counts AS (SELECT part, filter_order, step, own, count(*) FILTER (NOT fails AND NOT gone) AS kept, count(*) FILTER (fails AND NOT gone) AS removed,
        count(*) FILTER (fails AND gone) AS redundant, count(*) FILTER (only_own) AS unique_fails,
        count(*) FILTER (fails AND NOT gone AND good) AS good_lost, count(*) FILTER (fails AND NOT gone AND toxic) AS toxic_lost
      FROM judged GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counts
"""

# every phrase of every piece is counted, without a sample or a border
_OP13 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3), (4)) AS s(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS ph, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
parts AS (SELECT lang, phrase, f AS a, cut, array_to_string(ph[1:cut], ' ') AS x, array_to_string(ph[cut + 1:k], ' ') AS y
          FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1)),
cuts AS (SELECT parts.lang, parts.phrase, a, cut, l.f AS l, r.f AS r, CAST(a::HUGEINT * 2000000 // (l.f + r.f) AS BIGINT) AS score
         FROM parts JOIN f AS l ON l.lang = parts.lang AND l.phrase = x JOIN f AS r ON r.lang = parts.lang AND r.phrase = y),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(ph[i:i + size - 1], ' ') AS phrase, max(f) AS longer
           FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM f)) GROUP BY ALL),
left_ AS (SELECT lang, phrase, a, l, r, score FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM left_ JOIN n USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

ORACLE: dict[str, str] = {"op11_suffix_dedup": _OP11, "op12_filter_audit": _OP12, "op13_phrase_collocations": _OP13, "op1_substring_dedup": _OP1, "op4_sharding": _OP4, "op5_mixing": _OP5, "op6_url_filter": _OP6, "op8_decontamination": _OP8}
