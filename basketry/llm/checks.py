"""DuckDB SQL with the same results as the numbered queries that SQL can express."""

from __future__ import annotations

import itertools

from basketry.llm import audit, infill, quality, secrets, urls
from basketry.llm.urls import LOWER, UPPER


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(name: str, pattern: str, group: int) -> str:
    """CTE with (uid, start, stop, own, value) of the non-overlapping matches of a pattern."""
    p = _literal(pattern)
    return f"""
    {name} AS (
      SELECT uid, own, value, stop - length(own) AS start, stop
      FROM (
        SELECT uid, own, value, sum(length(gap) + length(own)) OVER (PARTITION BY uid ORDER BY i) AS stop
        FROM (
          SELECT uid, unnest(range(1, len(own) + 1)) AS i, unnest(own) AS own, unnest(value) AS value,
            unnest(gaps[1:len(own)]) AS gap
          FROM (
            SELECT uid, regexp_extract_all(text, {p}, 0) AS own, regexp_extract_all(text, {p}, {group}) AS value,
              regexp_split_to_array(text, {p}) AS gaps
            FROM texts WHERE regexp_matches(text, {p})))))"""


def op1_secret_scans() -> str:
    w = secrets.WINDOW
    terms = ", ".join(map(str, secrets.spread_terms()))
    return f"""
    WITH texts AS (
      SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
    {_matches("assigned", secrets.ASSIGN, 2)},
    {_matches("access", secrets.ACCESS, 0)},
    {_matches("hexes", secrets.HEX, 0)},
    {_matches("runs", secrets.CANDIDATE, 0)},
    windows AS (
      SELECT uid, start, o, substr(own, o + 1, {w}) AS part
      FROM (SELECT uid, start, own, unnest(range(0, length(own) - {w} + 1)) AS o FROM runs
            WHERE NOT regexp_matches(own, {_literal(secrets.allow_pattern())}))),
    letters AS (
      SELECT uid, start, o, part, unnest(string_split(part, '')) AS c FROM windows),
    spreads AS (
      SELECT uid, start, o, part, sum([{terms}][n + 1]) AS spread
      FROM (SELECT uid, start, o, part, c, count(*) AS n FROM letters GROUP BY ALL) GROUP BY ALL),
    hits AS (
      SELECT uid, start, o FROM spreads
      WHERE regexp_matches(part, '[0-9]') AND (
        regexp_full_match(part, '[0-9a-f]*|[0-9A-F]*') AND spread <= {secrets.spread_bound(secrets.HEX_BITS)}
        OR regexp_full_match(part, '[0-9a-z]*|[0-9A-Z]*') AND spread <= {secrets.spread_bound(secrets.SINGLE_CASE_BITS)}
        OR regexp_matches(part, '[A-Z]') AND regexp_matches(part, '[a-z]')
          AND spread <= {secrets.spread_bound(secrets.MIXED_BITS)})),
    islands AS (
      SELECT uid, start, o, sum(fresh) OVER (PARTITION BY uid, start ORDER BY o) AS island
      FROM (SELECT *, CASE WHEN o - lag(o) OVER (PARTITION BY uid, start ORDER BY o) <= {w} THEN 0 ELSE 1 END AS fresh
            FROM hits)),
    spans AS (
      SELECT uid, 0 AS kind, start, stop FROM assigned WHERE length(value) >= {secrets.ASSIGN_LEAST}
      UNION ALL SELECT uid, 1, start, stop FROM access
      UNION ALL SELECT uid, 2, start, stop FROM hexes
      UNION ALL SELECT uid, 3, start + min(o), start + max(o) + {w} FROM islands GROUP BY uid, start, island),
    named AS (
      SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start || ':' || stop AS span FROM spans),
    joined AS (
      SELECT uid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex,
        string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
        string_agg(span, ',' ORDER BY start, kind) AS spans
      FROM named GROUP BY uid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN joined USING (uid)"""


def op8_url_filters() -> str:
    ranked = sorted(urls.RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    fits = [
        (kind, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for kind, h, p in ranked
    ]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for _, r, f in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{k}'" for k, _, f in fits) + " END"
    labels = ", ".join(f"'{x}'" for x in urls.LISTED_LABELS)
    return rf"""
    WITH cut AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS after
      FROM (SELECT page_id, coalesce(rest, '') AS rest FROM cut)),
    fields AS (
      SELECT page_id, host, regexp_extract(after, '^[^?#]*') AS path,
        regexp_extract(after, '^[^?#]*\?([^#]*)', 1) AS query
      FROM parts),
    terms AS (
      SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'),
        lambda t: t <> '' AND NOT regexp_matches(t, '{urls.TRACKING}'))), '&') AS kept
      FROM fields),
    forms AS (
      SELECT *, CASE WHEN host <> '' THEN
        regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)?$', '') || regexp_replace(path, '/+$', '')
        || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canonical
      FROM terms),
    listed AS (
      SELECT DISTINCT canonical FROM forms
      WHERE canonical IS NOT NULL AND list_has_any(string_split(host, '.'), [{labels}])),
    judged AS (
      SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict,
        canonical IS NOT NULL AND canonical IN (SELECT canonical FROM listed) AS listed
      FROM forms)
    SELECT page_id, host, path, rule, listed,
      coalesce(verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged"""


def op9_quality_rules() -> str:
    w = quality.REPEAT_WINDOW
    return rf"""
    WITH texts AS (
      SELECT row_number() OVER () AS uid, doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text
      FROM documents),
    words AS (
      SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
    spots AS (
      SELECT uid, i, array_to_string(w[i:i + {w - 1}], ' ') AS gram
      FROM (SELECT uid, w, unnest(range(1, len(w) - {w} + 2)) AS i FROM words)),
    twice AS (
      SELECT uid, i FROM (SELECT uid, i, count(*) OVER (PARTITION BY uid, gram) AS n FROM spots) WHERE n > 1),
    repeated AS (
      SELECT uid, count(DISTINCT i + j) AS n_repeat_words FROM twice, range({w}) t(j) GROUP BY uid),
    raw_lines AS (
      SELECT uid, source, text, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
      FROM (SELECT uid, source, text, unnest(string_split(text, chr(10))) AS line FROM texts)),
    lines AS (
      SELECT uid, source, text, line, len(lw) AS n,
        translate(array_to_string(lw, ' '), '{UPPER}123456789', '{LOWER}000000000') AS plain
      FROM raw_lines WHERE len(lw) > 0),
    dups AS (
      SELECT uid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY uid),
    hosts AS (SELECT source, count(DISTINCT text) AS host_docs FROM texts GROUP BY source),
    bad AS (
      SELECT source, plain
      FROM (SELECT source, plain, count(DISTINCT text) AS docs FROM lines GROUP BY ALL) JOIN hosts USING (source)
      WHERE docs > {quality.MIN_DOCS} AND (docs > host_docs * {quality.MAX_SHARE}::DOUBLE OR docs > {quality.MOST_DOCS})),
    lost AS (
      SELECT uid, sum(n)::BIGINT AS removed_words FROM lines JOIN bad USING (source, plain) GROUP BY uid),
    counted AS (
      SELECT doc_id, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(removed_words, 0)::BIGINT AS removed_words
      FROM words LEFT JOIN repeated USING (uid) LEFT JOIN dups USING (uid) LEFT JOIN lost USING (uid)),
    judged AS (
      SELECT *, n_words < {quality.MIN_WORDS}
        OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)
    SELECT *, NOT base_failed AND NOT (
      removed_words > 0 AND (n_words - removed_words < n_words * {quality.MIN_LEFT}::DOUBLE
        OR n_words - removed_words < {quality.LEAST_LEFT})) AS kept
    FROM judged"""


def op12_filter_audit() -> str:
    orders = ", ".join("'" + "".join(p) + "'" for p in itertools.permutations(audit.FILTERS))
    bit = f"(1 << (strpos('{audit.FILTERS}', %s) - 1))"
    own = bit % "substr(filter_order, step, 1)"
    return rf"""
    WITH texts AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    words AS (
      SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
    marks AS (
      SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    failed AS (
      SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
        (len(w) < {audit.LEAST_WORDS})::INT
        + 2 * (100 * len(list_distinct(w)) < {audit.LEAST_DISTINCT_PERCENT} * len(w))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {audit.MOST_CAPITALS_PERCENT} * length(text))::INT
        + 8 * regexp_matches(text, '[{audit.SIGNS}]')::INT
        + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)::INT AS fails
      FROM words LEFT JOIN marks USING (doc_id)),
    masks AS (
      SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM failed GROUP BY ALL),
    sets AS (SELECT unnest(range({audit.SUBSETS}))::INT AS s),
    passing AS (
      SELECT part, s, coalesce(sum(n) FILTER (fails & s = 0), 0) AS n,
        coalesce(sum(good) FILTER (fails & s = 0), 0) AS good, coalesce(sum(toxic) FILTER (fails & s = 0), 0) AS toxic
      FROM masks, sets GROUP BY ALL),
    orders AS (SELECT unnest([{orders}]) AS filter_order),
    steps AS (
      SELECT filter_order, step::INT AS step, {own} AS own,
        list_sum([{bit % "x"} FOR x IN string_split(substr(filter_order, 1, step - 1), '') IF x <> ''])::INT AS before
      FROM orders, range(1, 6) t(step)),
    cut AS (
      SELECT filter_order, step, own, coalesce(before, 0) AS before, coalesce(before, 0) | own AS after FROM steps),
    removals AS (
      SELECT p.part, filter_order, step, own, q.n AS kept, p.n - q.n AS removed,
        p.good - q.good AS good_lost, p.toxic - q.toxic AS toxic_lost
      FROM cut JOIN passing p ON p.s = before JOIN passing q ON q.s = after AND q.part = p.part),
    shares AS (SELECT part, own, sum(removed) AS shapley FROM removals GROUP BY ALL),
    failing AS (
      SELECT part, own, coalesce(sum(n) FILTER (fails & own > 0), 0) AS fail, coalesce(sum(n) FILTER (fails = own), 0) AS only_own
      FROM masks, (SELECT DISTINCT own FROM steps) GROUP BY ALL)
    SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, kept::BIGINT AS kept, removed::BIGINT AS removed,
      (fail - removed)::BIGINT AS redundant, only_own::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
      toxic_lost::BIGINT AS toxic_lost, shapley::BIGINT AS shapley
    FROM removals JOIN shares USING (part, own) JOIN failing USING (part, own)"""


def op13_fill_in_middle() -> str:
    p, s, m = infill.PREFIX, infill.SUFFIX, infill.MIDDLE
    draw = "('0x' || substr(digest, {}, 8))::BIGINT"
    h1, h2, h3, h4 = (draw.format(8 * k + 1) for k in range(4))
    return rf"""
    WITH texts AS (
      SELECT doc_id, coalesce(text, '') AS text, sha256('{infill.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
    units AS (
      SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM texts),
    drawn AS (
      SELECT *, len(u) AS n, {h1} % (len(u) + 1) AS a, {h2} % (len(u) + 1) AS b,
        CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}')
          OR {h3} % 100 >= {infill.FILL_PERCENT} THEN 'plain'
          WHEN {h4} % 100 < {infill.SUFFIX_FIRST_PERCENT} THEN 'spm' ELSE 'psm' END AS form
      FROM units),
    parts AS (
      SELECT *, coalesce(array_to_string(u[1:least(a, b)], ''), '') AS first,
        coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS mid,
        coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS rest
      FROM drawn)
    SELECT doc_id, n::BIGINT AS n, form,
      CASE WHEN form <> 'plain' THEN length(first) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || first || '{s}' || rest || '{m}' || mid
        ELSE '{s}' || rest || '{p}' || first || '{m}' || mid END) AS output_sha256,
      sha256(text) AS restored_sha256
    FROM parts"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scans": op1_secret_scans(),
        "op8_url_filters": op8_url_filters(),
        "op9_quality_rules": op9_quality_rules(),
        "op12_filter_audit": op12_filter_audit(),
        "op13_fill_in_middle": op13_fill_in_middle(),
    }
