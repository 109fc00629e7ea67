"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

import hashlib

import regex

from stratum.llm import license_digest, rule_ledger

WORD = r"[^\x20\x09-\x0D]+"


def op5_sql() -> str:
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(list_slice(ws, i, i + 2), ' ') END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 90 * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(r.c) FROM r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""


def canonical_text(text: str, title: bool = True) -> str:
    """A known text's canonical form, in plain Python."""
    plain = regex.sub(r"[^\p{L}\p{N}\n]+", " ", text.lower())
    for variant, one in license_digest.SPELLINGS:
        plain = plain.replace(variant, one)
    lines = [x.strip() for x in plain.split("\n") if x.strip()][0 if title else 1 :]
    own = " ".join(x for x in lines if not regex.match(license_digest.COPYRIGHT, x))
    return regex.sub(*license_digest.ENDORSE, own)


def op7_sql() -> str:
    plain = r"regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\n]+', ' ', 'g')"
    for variant, one in license_digest.SPELLINGS:
        plain = f"replace({plain}, '{variant}', '{one}')"
    lines = f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    names: dict[str, str] = {}
    for name, text in sorted(license_digest.known_texts().items()):
        for title in (True, False):
            names.setdefault(hashlib.md5(canonical_text(text, title).encode()).hexdigest(), name)
    values = ", ".join(f"('{d}', '{n}')" for d, n in sorted(names.items()))
    said = ", ".join(
        "CASE WHEN " + " OR ".join(f"contains(whole, ' {p} ')" for p in phrases) + f" THEN '{name}' END"
        for name, phrases in sorted(license_digest.PHRASES.items())
    )
    pattern, one = license_digest.ENDORSE
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {lines} AS ls FROM documents),
c AS (SELECT doc_id, text, ' ' || array_to_string(ls, ' ') || ' ' AS whole,
  md5(regexp_replace(array_to_string(list_filter(ls, lambda x: NOT regexp_matches(x, '{license_digest.COPYRIGHT}')), ' '), '{pattern}', '{one}', 'g')) AS digest FROM t),
n AS (SELECT doc_id, digest, list_sort(list_distinct(list_filter(
  list_concat([{said}], regexp_extract_all(text, '{license_digest.SPDX}', 1)), lambda x: x IS NOT NULL))) AS names FROM c)
SELECT doc_id, digest, k.name AS license, CASE WHEN len(names) > 0 THEN array_to_string(names, ',') END AS notices
FROM n LEFT JOIN (VALUES {values}) k(known, name) ON k.known = n.digest
"""


KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def line_dedup_sql(source: str = "documents") -> str:
    """``doc_id, kept_text, n_lines, n_dropped`` over a table of texts."""
    return f"""
SELECT x.doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept_text, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
FROM (SELECT s.doc_id, s.i, s.line, coalesce(h.last <> s.doc_id, false) AS gone
  FROM (SELECT doc_id, i, line, {KEY} AS k FROM (
    SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {source}))) s
  LEFT JOIN (SELECT {KEY} AS k, max(doc_id) AS last FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {source})
    GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5 AND length(k) >= 40) h ON h.k = s.k) x
GROUP BY 1
"""


def op8_sql() -> str:
    return f"SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept_text, '')) AS kept_sha256 FROM ({line_dedup_sql()})"


def op9_sql() -> str:
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in rule_ledger.RULES)
    return rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 2) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM g) WHERE times > 1) GROUP BY 1),
l AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS u FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '{WORD}') GROUP BY 1),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n - l.u, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
  coalesce(l.n, 0) AS n_lines, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN l ON l.doc_id = w.doc_id),
b AS (SELECT *, ({bits})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & {rule_ledger.POLICIES[1].mask}) <> 0 AS base_failed, (fail_bits & {rule_ledger.POLICIES[2].mask}) = 0 AS kept, fail_bits FROM b
"""


def ablation_sql() -> str:
    def line(p, r):
        bit = 1 << r.bit
        return (
            f"SELECT {p.version} AS version, '{r.name}' AS rule, count(*) FILTER (WHERE fail_bits & {bit} <> 0) AS n_fail, "
            f"count(*) FILTER (WHERE fail_bits & {p.mask} = {bit}) AS n_only FROM b"
        )

    lines = [line(p, r) for p in rule_ledger.POLICIES.values() for r in rule_ledger.RULES if r.name in p.rules]
    return f"WITH b AS ({op9_sql()})\n" + "\nUNION ALL ".join(lines)


def op11_sql() -> str:
    def terms(table: str, key: str) -> str:
        lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        each = rf"SELECT row_number() OVER () AS r, {key}, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM {table}"
        return f"SELECT r, {key}, t, count(*) AS tf FROM (SELECT r, {key}, unnest(ts) AS t FROM ({each})) GROUP BY ALL"

    return f"""
WITH p AS ({terms('documents', 'doc_id')}), q AS ({terms('benchmark', 'item_id')}),
d AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY 1),
z AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d),
w AS (SELECT t, floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM p GROUP BY 1), z),
m AS (SELECT r, 100 - 25 + ((25 * n * nd) // l) AS m FROM d, z),
s AS (SELECT q.r, q.item_id, p.r AS pr, p.doc_id, sum(q.tf * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * m.m)))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t) JOIN m ON m.r = p.r GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_partenum": op5_sql(),
        "op7_licenses": op7_sql(),
        "op8_line_runs": op8_sql(),
        "op9_rule_ledger": op9_sql(),
        "rule_ablation": ablation_sql(),
        "op11_block_max": op11_sql(),
    }
