"""SQL counterparts of this package's queries, where SQL can express them."""

from __future__ import annotations

from tripmill.llm import licenses, sharding, url_rules

ORACLE: dict[str, str] = {}

ORACLE["op2_extendible_shards"] = f"""
WITH docs AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
    CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')))[1:15] AS BIGINT) AS h
  FROM documents),
buckets AS (
  SELECT depth, h >> ({sharding.BITS} - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS bytes
  FROM docs, (SELECT CAST(unnest(range({sharding.BITS} + 1)) AS INTEGER) AS depth) GROUP BY ALL),
placed AS (
  SELECT docs.*, buckets.*, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS k
  FROM docs JOIN buckets ON h >> ({sharding.BITS} - depth) = prefix
  WHERE bytes <= {sharding.SHARD_BYTES} OR depth = {sharding.BITS})
SELECT doc_id, n_bytes, depth, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
  CAST(0 AS BIGINT) AS part, bytes AS shard_bytes
FROM placed WHERE k = 1"""


def _spelled(text: str) -> str:
    plain = f"' ' || {text} || ' '"
    for odd, usual in licenses.SPELLINGS:
        plain = f"replace({plain}, ' {odd} ', ' {usual} ')"
    return f"trim({plain})"


def _lined(source: str, *keys: str) -> str:
    """``keys, lines, canon``: canonical lines that are not empty, and the canonical whole text."""
    names = ", ".join(keys)
    rights = f"(regexp_matches(l, '{licenses.SIGNED}') OR (regexp_matches(l, '{licenses.NAMED}') AND NOT regexp_matches(l, '{licenses.WORDED}')))"
    plain = f"trim(regexp_replace(regexp_replace(l, '{licenses.ITEM}', ''), '{licenses.OTHER}', ' ', 'g'))"
    return f"""(
  SELECT {names}, lines, {_spelled("array_to_string(CASE WHEN len(own) > 0 THEN own ELSE lines END, ' ')")} AS canon
  FROM (SELECT {names}, lines, list_filter(lines, lambda l: NOT starts_with(l, '{licenses.SPDX}')) AS own FROM (
    SELECT {names}, list_filter(list_transform(
      list_filter(cut, lambda l, i: kinds[i] = 0 OR (kinds[i] = 1 AND (i = 1 OR kinds[i - 1] <> 2))),
      lambda l: {_spelled(plain)}), lambda l: l <> '') AS lines
    FROM (SELECT {names}, cut, list_transform(cut, lambda l:
        CASE WHEN {rights} THEN 2 WHEN regexp_matches(l, '{licenses.RESERVED}') THEN 1 ELSE 0 END) AS kinds
      FROM (SELECT {names}, string_split(lower(coalesce(text, '')), chr(10)) AS cut FROM {source})))))"""


_KNOWN = ", ".join(f"('{name}', '{text}')" for name, text in licenses.KNOWN)
_TITLES = ", ".join(f"('{name}', '{title}')" for name, titles in licenses.TITLES.items() for title in titles)
_END = licenses.END_OF_TERMS

ORACLE["op3_license_scan"] = f"""
WITH files AS (
  SELECT regexp_extract(filename, '([^/~]+)(~[^/]*)?[.]txt$', 1) AS license, content FROM read_text('{licenses.WHOLE_TEXTS}/*.txt')),
cuts AS (
  SELECT license, content AS text FROM files
  UNION SELECT license, string_split(content, '{_END}')[1] FROM files
  UNION SELECT license, CASE WHEN contains(content, '{_END}') THEN string_split(content, '{_END}')[1] || '{_END}' ELSE content END FROM files),
texts AS (SELECT license, text FROM cuts UNION SELECT license, replace(text, 'https://', 'http://') FROM cuts),
titled AS (
  SELECT license, text FROM texts
  UNION ALL SELECT license, title || chr(10) || text FROM texts JOIN (VALUES {_TITLES}) AS t(license, title) USING (license)
  UNION ALL SELECT license, text FROM (VALUES {_KNOWN}) AS k(license, text)),
known AS (SELECT canon, min(license) AS license FROM {_lined("titled", "license")} WHERE canon <> '' GROUP BY canon),
own AS MATERIALIZED (SELECT * FROM {_lined("documents", "doc_id")}),
found AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n_license_lines
  FROM (SELECT doc_id, unnest(lines) AS canon FROM own) JOIN known USING (canon) GROUP BY doc_id)
SELECT own.doc_id, known.license AS whole_license, coalesce(line_licenses, '') AS line_licenses,
  coalesce(n_license_lines, 0) AS n_license_lines
FROM own LEFT JOIN known USING (canon) LEFT JOIN found ON found.doc_id = own.doc_id"""

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in url_rules.RULES)

ORACLE["op9_url_rules"] = f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules AS (SELECT h || p AS rule, h, p, v FROM (VALUES {_RULES}) AS r(h, p, v))
SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, coalesce(max_by(v, length(rule)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op7_benchmark_phrases"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(10, len(w)) AS n FROM items WHERE len(w) > 0))),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM item_windows))),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, phrase)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op12_ranked_search"] = f"""
WITH docs AS (
  SELECT *, CAST(len(t) AS BIGINT) AS n FROM (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_LOW}, '{_TERMS}') AS t FROM documents) WHERE len(t) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS docs_all, CAST(sum(n) AS BIGINT) AS words_all FROM docs),
wanted AS (
  SELECT q, item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
    SELECT q, item_id, unnest(regexp_extract_all({_LOW}, '{_TERMS}')) AS term
    FROM (SELECT row_number() OVER () AS q, * FROM benchmark)) GROUP BY ALL),
postings AS (
  SELECT d, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs_all + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), whole),
shares AS (SELECT d, doc_id, 100 - 75 + (75 * n * docs_all) // words_all AS m FROM docs, whole),
scores AS (
  SELECT q, item_id, doc_id, d, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN shares USING (d) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, d) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10"""

_SPACED = r"[^\x20\x09-\x0D]+"

ORACLE["op11_jaccard_components"] = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '{_SPACED}') AS w FROM documents),
sets AS (
  SELECT r, doc_id, list_distinct(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM docs),
shingles AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.r AS a, b.r AS b FROM shingles a JOIN shingles b USING (x) WHERE a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT own.doc_id, CAST(len(own.s) AS BIGINT) AS n_shingles, min(other.doc_id) AS component_id
FROM sets own JOIN reach ON reach.a = own.r JOIN sets other ON other.r = reach.b
GROUP BY own.r, own.doc_id, len(own.s)"""
