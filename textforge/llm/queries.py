"""The dealt operators applied to their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from textforge.llm.align import op12_tokenizer_alignment
from textforge.llm.cluster import op11_centroid_clustering
from textforge.llm.decontaminate import op10_decontamination
from textforge.llm.exact_dedup import op7_exact_dedup
from textforge.llm.licenses import license_sql, op13_license_scan
from textforge.llm.lm_score import op9_lm_scoring, op9_lm_scoring_full
from textforge.llm.near_dedup import op3_near_dedup
from textforge.llm.packing import op4_best_fit_packing
from textforge.llm.pii import op2_pii
from textforge.llm.quality import op5_quality_classifier
from textforge.llm.secrets import op8_secrets
from textforge.llm.url_filter import op1_url_filter
from textforge.llm.warc import op6_warc

REGISTRY = {
    "op1_url_filter": op1_url_filter,
    "op2_pii": op2_pii,
    "op3_near_dedup": op3_near_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_warc": op6_warc,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_secrets": op8_secrets,
    "op9_lm_scoring": op9_lm_scoring,
    "op9_lm_scoring_full": op9_lm_scoring_full,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_license_scan": op13_license_scan,
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)



def _found(kind: str, rank: int, pattern: str, holds: str = "true") -> str:
    """Spans of one kind: gaps and matches in turn make up the text, so their lengths give places."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + length(value) AS stop FROM (
    SELECT doc_id, text, m[i] AS value, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM (SELECT doc_id, text, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}') AS m FROM d),
      unnest(range(1, len(m) + 1)) AS t(i))
  WHERE {holds}"""


def _span_sql(found: list[str], base: int, kinds: tuple[str, ...], order: str) -> str:
    counts = ", ".join(f"count(s.doc_id) FILTER (s.kind = '{k}') AS n_{k}" for k in kinds)
    text = "s.kind || ':' || s.start || ':' || s.stop"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(found)})
SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({text}, ',' ORDER BY {order}) FILTER (s.rank < {base}), '')) AS base_sha256,
  coalesce(string_agg({text}, ',' ORDER BY {order}) FILTER (s.kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS})[i] AS INT)
    WHEN CAST(reverse({_DIGITS})[i] AS INT) > 4 THEN 2 * CAST(reverse({_DIGITS})[i] AS INT) - 9
    ELSE 2 * CAST(reverse({_DIGITS})[i] AS INT) END)) % 10 = 0"""
_MOD97 = """list_reduce(list_transform(string_split(substr(replace(value, ' ', ''), 5) || substr(replace(value, ' ', ''), 1, 4), ''),
    lambda c: CASE WHEN c <= '9' THEN CAST(c AS INT) ELSE ascii(c) - 55 END),
    lambda a, b: (CASE WHEN b > 9 THEN a * 100 ELSE a * 10 END + b) % 97) = 1"""
_PII = [
    _found("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    _found(
        "ip",
        1,
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR "
        "CAST('0' || right(ltrim(p, '0'), 3) AS INT) > 255)) = 0",
    ),
    _found("card", 2, r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
    _found("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
    _found("iban", 4, r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", _MOD97),
    _found(  # a number that is a whole run of digits and hyphens, after one of its context words
        "ssn",
        5,
        "[0-9-]+",
        "regexp_full_match(value, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND regexp_matches(lower(substr(text, "
        "greatest(start - 48, 0) + 1, start - greatest(start - 48, 0))), 'ssn|social|security|sozial|seguridad')",
    ),
]
_WINDOWS = "list_transform(range(1, length(value) - 18), lambda i: substr(value, i, 20))"
_ENTROPY = "round(list_entropy(string_split(w, '')), 9)"
_PART = "(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)"
_KNOWN = (
    f"(regexp_full_match(value, '{_PART}(?:[+/_=-]+{_PART})+') OR (regexp_full_match(value, "
    f"'[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}') AND {_MOD97}))"
)
_SECRETS = [
    _found(
        "assign",
        0,
        r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "length(regexp_extract(value, '^((?i)password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*"
        "[\"'']?([A-Za-z0-9+/_.=-]+)', 2)) >= 6",
    ),
    _found("access", 1, "AKIA[A-Z0-9]+", "length(value) >= 20"),
    _found("hex", 2, "[0-9a-f]+", "length(value) >= 24"),
    _found(
        "entropy",
        3,
        "[A-Za-z0-9+/_=-]{20,}",
        f"""regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND NOT regexp_matches(value, '^[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}$')
    AND NOT regexp_matches(value, '(?i)^(sha(1|256|384|512)|md5)[-_=]')
    AND NOT regexp_matches(value, '(?i)example|placeholder|changeme|x{{6}}|0123456789|abcdefgh')
    AND len(list_filter({_WINDOWS}, lambda w: (regexp_full_match(w, '[0-9a-fA-F]+') AND {_ENTROPY} >= 3.05)
      OR {_ENTROPY} >= 3.95 OR (NOT {_KNOWN} AND (({_ENTROPY} >= 3.34 AND regexp_full_match(w, '[A-Z2-7]+|[a-z2-7]+'))
        OR ({_ENTROPY} >= 3.40 AND regexp_full_match(w, '[A-Z0-9]+|[a-z0-9]+')) OR {_ENTROPY} >= 3.64)))) > 0""",
    ),
]


def _kmeans(k: int = 8, rounds: int = 10) -> str:
    """Every round as two named queries: the nearest centroid of each row, then the floored means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT r, arg_min(c.n, s.d * {k} + c.n) AS n, min(s.d) AS d
  FROM v CROSS JOIN c{i} AS c, LATERAL (SELECT list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d) AS s
  GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT n, j, sum(x[j]) AS s, count(*) AS m FROM a{i} JOIN v USING (r), unnest(range(1, 65)) AS t(j) GROUP BY n, j),
c{i + 1} AS MATERIALIZED (SELECT c.n, coalesce(new.x, c.x) AS x FROM c{i} AS c LEFT JOIN (
  SELECT n, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY j) AS x FROM m{i} GROUP BY n) AS new USING (n))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS n, x FROM (
  SELECT sha256('3:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {k})),{",".join(steps)}
SELECT vec_id, CAST(n AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} AS c USING (n)"""


ORACLES = {
    "op11_centroid_clustering": _kmeans(),
    "op13_license_scan": license_sql(),
    "op2_pii": _span_sql(_PII, 4, ("email", "ip", "card", "phone"), "s.rank, s.start"),
    "op8_secrets": _span_sql(_SECRETS, 3, ("assign", "access", "hex"), "s.start, s.rank"),
    "op1_url_filter": """
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id),
l AS (SELECT name || '.' || ending AS host FROM
  (VALUES ('ads-track'), ('adult-x'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) AS a(name),
  (VALUES ('example.com'), ('example.net'), ('example.org')) AS b(ending)),
listed AS (SELECT DISTINCT p.page_id FROM p JOIN l ON p.host = l.host OR ends_with(p.host, '.' || l.host)
  WHERE starts_with(p.path, '/'))
SELECT p.page_id, p.host, p.path, rule,
  coalesce(verdict, CASE WHEN listed.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fits USING (page_id) LEFT JOIN listed USING (page_id)""",
    "op6_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT page_id, payload_bytes, x, list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32 AS INT) + 1, 1)) AS c FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS last FROM d)
SELECT page_id, payload_bytes, array_to_string(c, '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM g""",
    "op7_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT *, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY text_sha256, doc_id) AS nth
  FROM d WINDOW same AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND nth = 1 AS kept, text_sha256 FROM g""",
    "op9_lm_scoring": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT r, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS history
  FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
one AS (SELECT word, count(*) AS n FROM t GROUP BY word),
two AS (SELECT history, word, count(*) AS n FROM t WHERE history IS NOT NULL GROUP BY ALL HAVING count(*) >= 2),
total AS (SELECT count(*) AS n FROM t),
s AS (SELECT r, history IS NOT NULL AND two.n IS NULL AS backed, CASE
    WHEN history IS NULL THEN ln(one.n / total.n)
    WHEN two.n IS NULL THEN ln(one.n / total.n) + ln(0.4)
    ELSE ln(two.n / before.n) END AS score
  FROM t CROSS JOIN total JOIN one USING (word) LEFT JOIN two USING (history, word)
  LEFT JOIN one AS before ON before.word = t.history)
SELECT doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, count(*) FILTER (WHERE backed) AS n_backoff,
  round(coalesce(sum(score), 0), 4) AS score
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id""",
    # Every n-gram of a document is in the counts, so no word backs off.
    "op9_lm_scoring_full": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT r, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS c
  FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
one AS (SELECT a, count(*) AS n FROM t GROUP BY ALL),
two AS (SELECT b, a, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY ALL),
three AS (SELECT c, b, a, count(*) AS n FROM t WHERE c IS NOT NULL GROUP BY ALL),
s AS (SELECT r, CASE WHEN t.c IS NOT NULL THEN ln(three.n / pair.n) WHEN t.b IS NOT NULL THEN ln(two.n / word.n)
    ELSE ln(one.n / (SELECT count(*) FROM t)) END AS score
  FROM t JOIN one ON one.a = t.a LEFT JOIN one AS word ON word.a = t.b LEFT JOIN two ON (two.b, two.a) = (t.b, t.a)
  LEFT JOIN two AS pair ON (pair.b, pair.a) = (t.c, t.b)
  LEFT JOIN three ON (three.c, three.b, three.a) = (t.c, t.b, t.a))
SELECT doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, CAST(0 AS BIGINT) AS n_backoff,
  round(coalesce(sum(score), 0), 4) AS score
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id""",
    "op10_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
n AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS x
  FROM n, unnest(range(1, len(w) - size + 2)) AS t(i)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS x
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, x)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
