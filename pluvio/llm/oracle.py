"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM d),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM pos WHERE i + 7 <= len(w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(lead_i - i, 8))) AS n FROM (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS lead_i FROM rep) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS letter_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') AND NOT regexp_matches(x, '[a-z]|[^\x00-\x7F]'))) AS capital_words,
    len(regexp_extract_all(t, '[{}]')) AS braces, regexp_matches(t, '[Ll][Oo][Rr][Ee][Mm] [Ii][Pp][Ss][Uu][Mm]') AS placeholder
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
k AS (
  SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
    n_words < 20 AS r0, 100 * n_repeat_words > 30 * n_words AS r1, word_chars < 2 * n_words OR word_chars > 20 * n_words AS r2,
    10 * n_symbols > 5 * n_words AS r3, 100 * (len(lines) - len(list_distinct(lines))) > 50 * len(lines) AS r4,
    100 * letter_words < 50 * n_words AS r5,
    100 * len(list_filter(lines, lambda x: regexp_matches(x, '\A[\x20\x09-\x0D]*[-*•]'))) > 90 * len(lines) AS r6,
    100 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) > 30 * len(lines) AS r7,
    100 * (len(array_to_string(lines, '')) - len(array_to_string(list_distinct(lines), ''))) > 30 * len(array_to_string(lines, '')) AS r8,
    placeholder AS r9, 10 * braces > n_words AS r10, 100 * capital_words > 50 * n_words AS r11,
    100 * len(list_filter(lines, lambda x: regexp_matches(x, '[.!?"''”’。！？][\x20\x09-\x0D]*\z'))) < 12 * len(lines) AS r12,
    100 * len(list_filter(lines, lambda x: len(x) <= 30)) > 67 * len(lines) AS r13 FROM m),
b AS (
  SELECT *, CAST(r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT + 128 * r7::INT + 256 * r8::INT
    + 512 * r9::INT + 1024 * r10::INT + 2048 * r11::INT + 4096 * r12::INT + 8192 * r13::INT AS BIGINT) AS fail_bits FROM k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 OR r1 AS base_failed, fail_bits & 4095 = 0 AS kept, fail_bits FROM b
"""

# the judged rows of OP1, each rule left out in turn
ABLATIONS = rf"""
WITH judged AS ({OP1}),
rules AS (SELECT * FROM (VALUES ('few_words', 1), ('repeated_windows', 2), ('word_length', 4), ('symbols', 8), ('repeated_lines', 16),
  ('letter_words', 32), ('bullet_lines', 64), ('ellipsis_lines', 128), ('repeated_line_chars', 256), ('placeholder', 512), ('braces', 1024), ('capitals', 2048),
  ('line_ends', 4096), ('short_lines', 8192)) AS r(rule, bit)),
policies AS (SELECT * FROM (VALUES ('base', 1, 3), ('full', 1, 31), ('full', 2, 4095), ('prose', 1, 16383)) AS p(policy, version, mask))
SELECT policy, version, rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits & mask = bit) AS n_only,
  count(*) FILTER (fail_bits & (mask - bit) = 0) AS n_kept_without
FROM judged, rules, policies WHERE bit & mask <> 0 GROUP BY policy, version, rule
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + 4), ' ')) AS g FROM pos),
sets AS (SELECT doc_id, list_sort(list(g)) AS s, count(*) AS n FROM sh GROUP BY doc_id),
reps AS (SELECT s, min(doc_id) AS rep, count(*) AS copies, any_value(n) AS n FROM sets GROUP BY s),
rs AS (SELECT rep, copies, n, unnest(s) AS g FROM reps),
ov AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, any_value(b.copies) AS cb, count(*) AS c
  FROM rs a JOIN rs b ON a.g = b.g AND a.rep <> b.rep GROUP BY a.rep, b.rep),
lk AS (SELECT a, b, cb FROM ov WHERE 5 * c >= 4 * (na + nb - c)),
reach AS (SELECT rep AS a, rep AS b FROM reps UNION SELECT reach.a, lk.b FROM reach JOIN lk ON reach.b = lk.a),
cls AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
nl AS (SELECT a, sum(cb) AS links FROM lk GROUP BY a)
SELECT documents.doc_id, coalesce(reps.rep, documents.doc_id) AS rep_id, coalesce(cls.class_id, documents.doc_id) AS class_id,
  CAST(coalesce(nl.links, 0) + coalesce(reps.copies - 1, 0) AS BIGINT) AS n_links
FROM documents LEFT JOIN sets ON documents.doc_id = sets.doc_id LEFT JOIN reps ON sets.s = reps.s
LEFT JOIN cls ON cls.a = reps.rep LEFT JOIN nl ON nl.a = reps.rep
"""


def _kind(name: str, order: int, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: gaps between matches and matches, summed up."""
    p = pattern.replace("'", "''")
    return rf"""
SELECT doc_id, '{name}' AS kind, {order} AS ord, s AS start, e AS end_ FROM (
  SELECT doc_id, i, sum(len(gap)) OVER k + sum(len(hit)) OVER k - len(hit) AS s, sum(len(gap)) OVER k + sum(len(hit)) OVER k AS e, inner_
  FROM (SELECT doc_id, unnest(range(len(f))) AS i, unnest(list_slice(g, 1, len(f))) AS gap, unnest(f) AS hit, unnest(x) AS inner_
    FROM (SELECT doc_id, regexp_split_to_array(t, '{p}') AS g, regexp_extract_all(t, '{p}') AS f, regexp_extract_all(t, '{p}', {group}) AS x FROM d))
  WINDOW k AS (PARTITION BY doc_id ORDER BY i)) WHERE len(inner_) >= {least}"""


def op3() -> str:
    from pluvio.llm.op03_secret_scans import KINDS
    found = " UNION ALL ".join(_kind(k.name, i, k.pattern, k.group, k.min_chars) for i, k in enumerate(KINDS))
    joined = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(end_ AS BIGINT), ',' ORDER BY start, ord)"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  {joined} FILTER (kind IN ('assign', 'access', 'hex')) AS base, {joined} AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""


OP6 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 12), ' ') AS g, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, lens) WHERE i + n - 1 <= len(w)),
occ AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN win ON dw.g = win.g AND dw.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

_DRAW = [f"CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), {1 + 8 * k}, 8) AS BIGINT)" for k in range(4)]
OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  {', '.join(f'{x} AS h{k + 1}' for k, x in enumerate(_DRAW))} FROM documents),
c AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS z FROM d),
p AS (SELECT *, array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, z), '') AS m, array_to_string(list_slice(u, z + 1, len(u)), '') AS s,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, len(u) AS n, form, CASE WHEN form <> 'plain' THEN len(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""

ORACLE = {"op1_quality_rules": OP1, "rule_ablations": ABLATIONS, "op2_ngram_jaccard": OP2, "op3_secret_scans": op3(), "op6_decontamination": OP6,
          "op11_fill_in_middle": OP11}
