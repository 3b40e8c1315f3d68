"""DuckDB SQL of the training-data queries that SQL can express.

Written as the plain definition of each result: whole windows instead of
ranges of keys, every unit against every template, every 3-word window.
"""

from __future__ import annotations

from . import license_scans, mixing, pii, quality_rules, secret_scans
from .license_texts import TEMPLATES

WORD = r"[^\x20\x09-\x0D]+"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _quality() -> str:
    stops = _quoted(sorted({v for w in quality_rules.STOP_WORDS for v in (w, w.capitalize())}))
    metric = {"n_words": "n_words", "repeat_ratio": "n_repeat_words / n", "mean_word_chars": "word_chars / n", "symbol_ratio": "n_symbols / n",
              "stop_ratio": "n_stop / n", "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)"}
    fails = [(n, f"{metric[m]} {op} {b}") for n, m, op, b in quality_rules.RULES]
    base = " OR ".join(c for n, c in fails if n in quality_rules.BASE)
    names = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in fails)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws FROM d),
places AS (SELECT r, unnest(ws) AS a, unnest(range(1, len(ws) + 1)) AS i FROM w),
windows AS (SELECT x.r, x.i, x.a || ' ' || y.a || ' ' || z.a AS g FROM places x JOIN places y ON y.r = x.r AND y.i = x.i + 1
            JOIN places z ON z.r = x.r AND z.i = x.i + 2),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(DISTINCT l) AS d FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '{WORD}') GROUP BY r),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(lines.n - lines.d, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
             len(list_filter(ws, lambda x: x IN ({stops}))) AS n_stop, coalesce(lines.n, 0) AS n_lines, greatest(len(ws), 1) AS n
      FROM w LEFT JOIN lines USING (r) LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base} AS base_failed,
       NOT ({" OR ".join(c for _, c in fails)}) AS kept, concat_ws(',', {names}) AS failed_rules
FROM m"""


def _mixing() -> str:
    weights = ", ".join(f"{w}.0" for w in mixing.WEIGHTS)
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
                  substr(md5('7:' || doc_id), 1, 12) AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(list_extract([{weights}], 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}) AS DOUBLE) AS w,
             CAST({mixing.MAX_EPOCHS} * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
      FROM w WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(level, (cap / w, source IS NULL, source)) FROM l WHERE level <= cap / w)) AS target FROM l),
p AS (SELECT d.doc_id, d.size, d.source, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END AS BIGINT) AS taken
FROM p"""


def _licenses() -> str:
    rows = ",\n".join(f"({_quoted([name])}, [{_quoted(license_scans.template_bigrams(text))}])" for name, text in TEMPLATES)
    return f"""
WITH templates(name, grams) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
units AS (SELECT DISTINCT r, trim(regexp_replace(lower(u), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS u FROM (
  SELECT r, unnest(list_concat(string_split(t, chr(10)), string_split_regex(t, '[.!?]+\\s+|\\n'), string_split_regex(t, '\\n[ \\t]*\\n'), [t])) AS u FROM d)),
grams AS (SELECT r, u, list_distinct(list_transform(range(1, len(string_split(u, ' '))),
                 lambda i: string_split(u, ' ')[i] || ' ' || string_split(u, ' ')[i + 1])) AS g FROM units WHERE u LIKE '% %'),
hits AS (SELECT * FROM (SELECT r, u, name, 2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice FROM grams, templates) WHERE dice >= {license_scans.DICE}),
best AS (SELECT r, max(dice) AS dice, count(DISTINCT u) AS n_units, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM hits GROUP BY r)
SELECT d.doc_id, (SELECT min(name) FROM hits h WHERE h.r = d.r AND h.dice = best.dice) AS license, CAST(coalesce(best.dice, 0) AS DOUBLE) AS dice,
       coalesce(n_units, 0) AS n_units, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN best USING (r)"""


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


def _places(kind: str, k: int, pattern: str, text: str, source: str, keep: str) -> str:
    """keep, k, kind, s, e, m (the match) of every match: a match begins after the gaps and matches before it."""
    p = _sql(pattern)
    return f"""SELECT {keep}, {k} AS k, '{kind}' AS kind, s, s + length(m) AS e, m FROM (
  SELECT {keep}, h[i] AS m, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT {keep}, string_split_regex({text}, '{p}') AS g, regexp_extract_all({text}, '{p}') AS h,
               unnest(range(1, len(regexp_extract_all({text}, '{p}')) + 1)) AS i FROM {source}))"""


def _secrets() -> str:
    rules = secret_scans.BASE + secret_scans.WIDER
    n_base = len(secret_scans.BASE)
    found = []
    for k, (kind, pattern, value, least) in enumerate(rules):
        v = "m" if value == "(.+)" else f"regexp_extract(m, '{_sql(value)}', 1)"
        found.append(f"SELECT r, k, kind, s, e, v FROM (SELECT *, {v} AS v FROM ({_places(kind, k, pattern, 't', 'd', 'r')})) WHERE length(v) >= {least}")
    every = "\nUNION ALL\n".join(found)
    span = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k)"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, *_ in secret_scans.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, lang, coalesce(text, '') AS t FROM documents),
c AS ({every}),
held AS (SELECT v, source, coalesce('s' || source, 'n') || ' ' || coalesce('l' || lang, 'n') AS repo FROM c JOIN d USING (r)),
owners AS (SELECT v, count(DISTINCT coalesce('s' || source, 'n')) AS n, count(DISTINCT repo) AS n_repos FROM held GROUP BY v),
total AS (SELECT greatest(1, floor(count(DISTINCT coalesce('s' || source, 'n')) * {secret_scans.OWNER_SHARE})) AS most_owners,
                 greatest({secret_scans.MIN_REPOS}, floor(count(DISTINCT repo) * {secret_scans.REPO_SHARE})) AS most_repos FROM held),
letters AS (SELECT v, x, count(*) AS n FROM (SELECT v, unnest(string_split(v, '')) AS x FROM owners) GROUP BY v, x),
looks AS (SELECT v, -sum(n / length(v) * log2(n / length(v))) >= {secret_scans.MIN_ENTROPY}
                 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AS random FROM letters GROUP BY v),
j AS (SELECT c.*, random AND n <= most_owners AND n_repos <= most_repos AS live FROM c JOIN owners USING (v) JOIN looks USING (v) CROSS JOIN total),
per AS (SELECT r, {counts}, {span} FILTER (k < {n_base}) AS base, {span} AS spans,
               count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
        FROM j WHERE k < {n_base} OR live GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, *_ in secret_scans.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per USING (r)"""


def _pii() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    at = f"CAST(substr(reverse({digits}), CAST(i AS BIGINT), 1) AS INTEGER)"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {at} WHEN {at} > 4 THEN 2 * {at} - 9 ELSE 2 * {at} END)) % 10 = 0"
    valid = {"email": "true", "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}", "phone": f"length({digits}) BETWEEN 9 AND 15",
             "ip": "list_max(list_transform(string_split(m, '.'), lambda x: CAST(x AS HUGEINT))) <= 255"}
    key = {"email": "lower(m)", "ip": "lower(m)", "card": digits, "phone": digits}
    patterns = {**pii.PATTERNS, "card": r"[0-9](?:[\x20-]?[0-9])+"}
    base = "\nUNION ALL\n".join(
        f"SELECT r, k, kind, s, e, '{kind}:' || {key[kind]} AS key FROM ({_places(kind, k, patterns[kind], 't', 'd', 'r')}) WHERE {valid[kind]}"
        for k, kind in enumerate(pii.KINDS))
    span = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
b AS ({base}),
held AS (SELECT r, list({{'s': s, 'e': e}}) AS xs FROM b GROUP BY r),
rest AS (SELECT r, t AS x FROM d WHERE r NOT IN (SELECT r FROM held) UNION ALL
         SELECT r, array_to_string(list_transform(string_split(t, ''), lambda c, i:
                CASE WHEN len(list_filter(xs, lambda y: y.s < i AND i <= y.e)) > 0 THEN chr(10) ELSE c END), '') AS x FROM d JOIN held USING (r)),
n_e AS (SELECT key, count(DISTINCT r) AS n_e FROM b GROUP BY key),
outside AS (SELECT r, unnest(list_distinct(regexp_extract_all(lower(x), '{pii.TERM}'))) AS term FROM rest WHERE r IN (SELECT r FROM held)),
n_et AS (SELECT key, term, count(*) AS n_et FROM (SELECT DISTINCT r, key FROM b) JOIN outside USING (r) GROUP BY key, term),
n_t AS (SELECT term, count(*) AS n_t FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(t), '{pii.TERM}'))) AS term FROM d) GROUP BY term),
flagged AS (SELECT DISTINCT term FROM n_et JOIN n_e USING (key) JOIN n_t USING (term), (SELECT CAST(count(*) AS DOUBLE) AS n FROM d)
            WHERE n_e < n AND ln(n * n_et / (n_e * n_t)) / ln(n / n_e) >= {pii.GENERALISE}),
hit AS (SELECT r, x FROM rest WHERE r IN (SELECT r FROM (SELECT r, unnest(list_distinct(regexp_extract_all(lower(x), '{pii.TERM}'))) AS term FROM rest) JOIN flagged USING (term))),
extra AS (SELECT r, s, e FROM ({_places("term", 4, pii.TERM, "x", "hit", "r")}) WHERE lower(m) IN (SELECT term FROM flagged)),
every AS (SELECT r, k, kind, s, e FROM b UNION ALL SELECT r, 4, 'term', s, e FROM extra),
per AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*pii.KINDS, "term"))},
               {span} FILTER (k < 4) AS base, {span} AS spans FROM every GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_term, 0) AS n_terms
FROM d LEFT JOIN per USING (r)"""


ORACLE: dict[str, str] = {
    "op1_license_scans": _licenses(),
    "op3_mixing": _mixing(),
    "op6_secret_scans": _secrets(),
    "op7_pii": _pii(),
    "op8_quality_rules": _quality(),
}
