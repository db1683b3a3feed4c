r"""DuckDB SQL for the operators that SQL can express, over the same tables.

Language ID, toxicity, near dedup, mixing and BPE are beyond SQL; Maglev's table is filled
step by step and xxhash64 is not in DuckDB, so sharding is tested by brute force too.
"""

from __future__ import annotations

# fixed values, stated here again so that a wrong one in an operator shows
BASE_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = ("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in NAMES) + ")"
          + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX, OPAQUE = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9_-]{20,}"
LEAF = r"(?:[^ ]*[^ .!?] +){0,15}[^ ]+ *| +"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lower(expr: str) -> str:
    return f"translate({expr}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_filter(min_support: float = 0.002, min_confidence: float = 0.6, min_count: int = 10, min_lift: float = 1.1) -> str:
    def items(prefix: str, parts: str) -> str:
        return f"list_transform(list_filter({parts}, lambda x: x <> ''), lambda x: '{prefix}' || x)"

    tokens = "list_sort(list_distinct(list_concat(list_concat(list_concat(list_concat(" + ",\n    ".join([
        items("s:", "[" + _lower(r"regexp_extract(u, '(?s)^(.*?)://', 1)") + "]"),
        items("h:", "string_split(host, '.')") + ")",
        items("p:", "string_split_regex(regexp_replace(path, '[0-9]+', '#', 'g'), '[/.]')") + ")",
        items("q:", r"list_transform(string_split(regexp_extract(u, '(?s)^[^?#]*\?([^#]*)', 1), '&'), lambda x: string_split(x, '=')[1])") + ")",
        "CASE WHEN contains(u, '#') THEN ['f:yes'] ELSE [] END"]) + ")))"
    fits = [(rule, verdict, *rule.split("/", 1)) for rule, verdict in sorted(BASE_RULES, key=lambda r: (-len(r[0]), r[0]))]
    cases = "\n    ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}') THEN '{rule}'" for rule, _, h, p in fits)
    verdicts = " ".join(f"WHEN '{rule}' THEN '{verdict}'" for rule, verdict, _, _ in fits)
    return rf"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u, {_lower("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
parsed AS (
  SELECT *, CASE WHEN contains(u, '://') THEN {tokens} ELSE [] END AS tokens,
    CASE {cases} END AS rule
  FROM parts),
labelled AS (
  SELECT row_number() OVER () AS r, tokens, coalesce(quality = 0 OR toxic = 1, FALSE) AS blocked FROM parsed
  JOIN labels ON doc_id = TRY_CAST(regexp_extract(u, '://[^/?#]*[^?#]*?/([0-9]+)', 1) AS BIGINT)),
rows_of AS (
  SELECT token, list(r ORDER BY r) AS rs FROM (SELECT r, unnest(tokens) AS token FROM labelled) GROUP BY token),
telling AS (
  SELECT min(token) AS token FROM rows_of WHERE len(rs) < (SELECT count(*) FROM labelled) GROUP BY rs),
sets AS (
  SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS s, blocked
  FROM (SELECT tokens, blocked, unnest(range(1, CAST(pow(2, len(tokens)) AS BIGINT))) AS mask
        FROM (SELECT r, blocked, list_filter(tokens, lambda x: list_contains(known, x)) AS tokens
              FROM labelled, (SELECT coalesce(list(token), []) AS known FROM telling)))),
counts AS (
  SELECT s, count(*) AS n, count(*) FILTER (WHERE blocked) AS bad FROM sets GROUP BY s),
total AS (SELECT count(*) AS n, count(*) FILTER (WHERE blocked) AS bad FROM labelled),
rules AS (
  SELECT s, verdict, support, support / c.n AS confidence
  FROM (SELECT s, n, 'block' AS verdict, bad AS support FROM counts
        UNION ALL SELECT s, n, 'allow', n - bad FROM counts) c, total
  WHERE support >= greatest({min_count}, ceil({min_support} * total.n))
    AND support / c.n >= {min_confidence}
    AND support / c.n >= CAST({min_lift} AS DOUBLE) * (CASE verdict WHEN 'block' THEN total.bad ELSE total.n - total.bad END / total.n)),
best AS (
  SELECT t.tokens, arg_min({{'r': array_to_string(s, ' & '), 'c': confidence, 'v': verdict}},
                           {{'c': -confidence, 's': -support, 'r': array_to_string(s, ' & '), 'v': verdict}}) AS b
  FROM (SELECT DISTINCT tokens FROM parsed) t JOIN rules ON list_has_all(t.tokens, s) GROUP BY t.tokens)
SELECT page_id, host, path, rule,
       coalesce(CASE rule {verdicts} END, b.v, 'allow') AS verdict,
       b.r AS mined_rule, CAST(b.c AS DOUBLE) AS mined_confidence
FROM parsed LEFT JOIN best USING (tokens)"""


def _secret_scan(example_owners: int = 3, example_repos: int = 20) -> str:
    kinds = [("assign", ASSIGN, 2, "length(v) >= 6"), ("access", ACCESS, 0, "TRUE"), ("hex", HEX, 0, "TRUE"),
             ("opaque", OPAQUE, 0, "length(v) >= 20 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') "
              "AND len(list_distinct(string_split(v, ''))) >= 10")]
    one = []
    for k, (name, pattern, group, keep) in enumerate(kinds):
        p = _text(pattern)
        one.append(f"""
  SELECT r, doc_id, source, {k} AS kind, '{name}' AS name, s AS start, s + length(w) AS stop, v
  FROM (SELECT r, doc_id, source, whole[i] AS w, val[i] AS v,
               list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS s
        FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i
              FROM (SELECT r, doc_id, source, regexp_extract_all(t, {p}, 0) AS whole, regexp_extract_all(t, {p}, {group}) AS val,
                           string_split_regex(t, {p}) AS gap FROM d)))
  WHERE {keep}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(one)}),
spans AS (
  SELECT * FROM found f WHERE kind < 3 OR NOT EXISTS (
    SELECT 1 FROM found g WHERE g.r = f.r AND g.kind < 3 AND g.start < f.stop AND f.start < g.stop)),
owned AS (
  SELECT v, count(DISTINCT (source IS NULL, source)) AS n_owners,
         count(DISTINCT (source IS NULL, source, doc_id IS NULL, doc_id)) AS n_repos
  FROM spans GROUP BY v),
judged AS (
  SELECT s.*, CASE WHEN n_owners >= {example_owners} OR n_repos >= {example_repos} THEN 'example'
    WHEN n_owners = 1 AND length(s.v) >= 16 AND regexp_matches(s.v, '[0-9]') AND regexp_matches(s.v, '[A-Za-z]')
         AND len(list_distinct(string_split(s.v, ''))) >= 8 THEN 'live' ELSE 'unclear' END AS class
  FROM spans s JOIN owned o ON o.v = s.v),
hits AS (
  SELECT r, name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span, * EXCLUDE (r) FROM judged WHERE kind < 3 OR class = 'live')
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind, stop), '') AS spans,
       count(*) FILTER (WHERE class = 'live') AS n_live, count(*) FILTER (WHERE class = 'example') AS n_example
FROM d LEFT JOIN hits h ON h.r = d.r GROUP BY d.r, d.doc_id"""


EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {_lower("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""


def _fingerprint() -> str:
    def steps(source: str, text: str, name: str) -> str:
        """CTEs that add the fingerprint of `text`."""
        return f"""
{name}_a AS (
  SELECT *, list_transform(string_split({text}, chr(10)), lambda p: list_transform(regexp_extract_all(p, {_text(LEAF)}, 0), lambda x: md5(x))) AS leaves
  FROM {source}),
{name}_b AS (
  SELECT *, string_split(array_to_string(list_transform(list_transform(leaves, lambda x: md5(array_to_string(x, ','))),
    lambda m: m || CASE WHEN m < '4' THEN '|' ELSE ';' END), ''), '|') AS marked FROM {name}_a),
{name}_c AS (SELECT *, list_transform(marked, lambda s: md5(s)) AS sections FROM {name}_b),
{name} AS (
  SELECT * EXCLUDE (leaves, marked, sections), sha256(array_to_string(sections, ',')) AS {name}_root,
    list_transform(sections, lambda s: s[1:8]) AS {name}_sections,
    list_distinct(flatten(list_transform(leaves, lambda p: list_transform(p, lambda x: x[1:8])))) AS {name}_leaves,
    sha256(array_to_string(sections, ',')) || ':' || array_to_string(list_transform(sections, lambda s: s[1:8]), ',') || ':' ||
      array_to_string(list_transform(leaves, lambda p: array_to_string(list_transform(p, lambda x: x[1:8]), ',')), ';') AS {name}_print
  FROM {name}_c)"""

    def like(a: str, b: str) -> str:
        return (f"CASE WHEN {a}_root = {b}_root THEN 1.0 WHEN len({a}_leaves) + len({b}_leaves) = 0 THEN 0.0 "
                f"ELSE CAST(2.0 AS DOUBLE) * len(list_intersect({a}_leaves, {b}_leaves)) / (len({a}_leaves) + len({b}_leaves)) END")

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (
  SELECT doc_id, t, length(t) AS n_chars,
    coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS u FROM d),
e AS (SELECT *, substring(t, 1, n_chars - n_chars // 3) || substring(u, 1, n_chars // 3) AS edited FROM n),
{steps('e', 't', 'own')},
{steps('own', 'edited', 'new')},
{steps('new', 'u', 'nxt')}
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, own_print AS fingerprint, new_print AS edited_fingerprint,
       CAST({like('own', 'new')} AS DOUBLE) AS near_edited, CAST({like('own', 'nxt')} AS DOUBLE) AS near_next,
       array_to_string(list_filter(list_transform(new_sections, lambda s, i:
         CASE WHEN NOT list_contains(own_sections, s) THEN i - 1 END), lambda i: i IS NOT NULL), ',') AS edited_sections
FROM nxt"""


def _collocations(min_count: int = 10, contained_percent: int = 50, top: int = 2000) -> str:
    def score(left: str, right: str) -> str:
        return f"(1000000::hugeint * a * a) // ({left}::hugeint * {right})"

    return rf"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_lower("coalesce(text, '')")}, '[.,;:!?\n\x0B\x0C\r]')) AS piece
        FROM documents)),
grams AS MATERIALIZED (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) t(size) WHERE len(w) >= size)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= {min_count}),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored AS (
  SELECT lang, phrase, a, l, r, {score("l", "r")} AS score, row_number() OVER (PARTITION BY lang, phrase ORDER BY {score("l", "r")}, k) AS best
  FROM cuts),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE size = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE size = 3) GROUP BY ALL),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score::BIGINT AS score
  FROM scored s JOIN totals USING (lang) LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE best = 1 AND (longer IS NULL OR 100 * longer < {contained_percent} * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {top}"""


LLM_ORACLES: dict[str, str] = {
    "op1_url_filter": _url_filter(),
    "op2_secret_scan": _secret_scan(),
    "op6_exact_dedup": EXACT_DEDUP,
    "op9_fingerprint": _fingerprint(),
    "op11_collocations": _collocations(),
}
