"""DuckDB twins of the corpus queries that SQL can express."""

from __future__ import annotations

from faregate.llm import secrets

_WARC = """
    WITH payloads AS (
        SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex
        FROM pages),
    marked AS (
        SELECT *, max(page_id) OVER (PARTITION BY hex) AS first FROM payloads)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((('0x' || substr(hex, (5 * g + 1)::BIGINT, 5))::BIGINT >> s) & 31) + 1, 1)), '')), '')
               AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to,
           NULL::VARCHAR AS error
    FROM marked
"""

_EXACT = r"""
    WITH entries AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
                 count(*) OVER (PARTITION BY text_sha256) AS group_size
          FROM entries)
"""


def _tree(column: str) -> str:
    nodes = f"list_transform(string_split({column}, chr(10)), lambda x: sha256('paragraph:' || x))"
    sections = (
        f"list_transform(range(0, len({nodes}), 8), "
        f"lambda i: sha256('section:' || array_to_string(({nodes})[i + 1 : i + 8], '')))"
    )
    return f"sha256('root:' || array_to_string({sections}, ''))"


def _leaves(column: str) -> str:
    return rf"list_distinct(regexp_extract_all({column}, '[^\n]{{1,64}}'))"


def _likeness(a: str, b: str, same: str) -> str:
    return (
        f"CASE WHEN {same} THEN 1.0::DOUBLE WHEN len({a}) + len({b}) = 0 THEN 0.0::DOUBLE "
        f"ELSE 2.0::DOUBLE * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END"
    )


_FINGERPRINTS = f"""
    WITH numbered AS (
        SELECT doc_id, coalesce(text, '') AS value, length(coalesce(text, '')) AS n_chars FROM documents),
    paired AS (
        SELECT *, coalesce(lead(value) OVER down, first_value(value) OVER down) AS following
        FROM numbered WINDOW down AS (ORDER BY doc_id DESC)),
    edits AS (
        SELECT *, substr(value, 1, n_chars - n_chars // 3) || substr(following, 1, n_chars // 3) AS edited FROM paired),
    measured AS (
        SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
               {_tree('value')} AS fingerprint, {_tree('edited')} AS edited_fingerprint,
               {_tree('following')} AS next_fingerprint,
               {_leaves('value')} AS own, {_leaves('edited')} AS changed, {_leaves('following')} AS after
        FROM edits)
    SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
           {_likeness('own', 'changed', 'fingerprint = edited_fingerprint')} AS near_edited,
           {_likeness('own', 'after', 'fingerprint = next_fingerprint')} AS near_next
    FROM measured
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(pattern: str, kind: int, keep: str, value: str = "value", more: str = "") -> str:
    """Spans of a pattern as structs; ``keep`` tests a match ``x`` by its place ``i``."""
    hits, gaps = f"regexp_extract_all({value}, {_quoted(pattern)})", f"string_split_regex({value}, {_quoted(pattern)})"
    length = "list_transform({}, lambda y: length(y))"
    start = (
        f"(coalesce(list_sum({length.format(f'({gaps})[1:i]')}), 0) + "
        f"coalesce(list_sum({length.format(f'({hits})[1:i - 1]')}), 0))"
    )
    made = f"list_transform({hits}, lambda x, i: {{'start': {start}::BIGINT, 'kind': {kind}, 'finish': ({start} + length(x))::BIGINT, 'ok': {keep}{more}}})"
    return f"list_filter({made}, lambda s: s.ok)"


def _joined(spans: str) -> str:
    kinds = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    return (
        f"array_to_string(list_transform(list_sort({spans}), "
        f"lambda s: {kinds}[s.kind + 1] || ':' || s.start || ':' || s.finish), ',')"
    )


_PEAK = (
    f"list_max(list_transform(range(1, length(x) - {secrets.WINDOW} + 2), "
    f"lambda p: list_aggregate(string_split(substr(x, p, {secrets.WINDOW}), ''), 'entropy')))"
)
_SUSPICIOUS = (
    f"NOT regexp_matches(x, {_quoted(secrets.ALLOWED)}) AND {_PEAK} >= "
    f"CASE WHEN regexp_matches(x, '^[0-9a-fA-F]+$') THEN {secrets.THRESHOLDS['hex']} "
    f"WHEN regexp_matches(x, '^[A-Za-z0-9]+$') THEN {secrets.THRESHOLDS['alnum']} "
    f"ELSE {secrets.THRESHOLDS['base64']} END"
)
_SECOND = f"length((regexp_extract_all(value, {_quoted(secrets.ASSIGN)}, 1))[i]) >= {secrets.ASSIGN_LEAST}"
_PARTS = "[A-Za-z0-9+_-]{24,}"

_SECRETS = f"""
    WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS value FROM documents),
    found AS (
        SELECT rid, doc_id, {_spans(secrets.ASSIGN, 0, _SECOND)} AS assign, {_spans(secrets.ACCESS, 1, 'true')} AS access,
               {_spans(secrets.HEX, 2, 'true')} AS hex,
               {_spans(secrets.CANDIDATE, 3, 'true', more=", 'text': x")} AS runs
        FROM texts),
    merged AS (
        SELECT *, list_concat(list_concat(assign, access), hex) AS base FROM found),
    single AS (
        SELECT rid, base, unnest(runs) AS run FROM merged),
    opened AS (
        SELECT rid, base, run, unnest(list_distinct(list_filter(
                   list_append(list_transform(base, lambda b: b.finish), run.start),
                   lambda s: run.start <= s AND s < run.finish
                             AND len(list_filter(base, lambda b: b.start <= s AND s < b.finish)) = 0))) AS start
        FROM single WHERE NOT regexp_matches(run.text, {_quoted(secrets.SHAPES)})),
    closed AS (
        SELECT rid, run, start, coalesce(least(list_min(list_transform(
                   list_filter(base, lambda b: b.start >= start), lambda b: b.start)), run.finish), run.finish) AS finish
        FROM opened),
    pieces AS (
        SELECT rid, start, finish, substr(run.text, (start - run.start + 1)::BIGINT, (finish - start)::BIGINT) AS x
        FROM closed WHERE finish - start >= {secrets.WINDOW}),
    judged AS (
        SELECT *, {_SUSPICIOUS} AS ok FROM pieces),
    halves AS (
        SELECT rid, start AS first, unnest({_spans(_PARTS, 3, 'true', value='x', more=", 'text': x")
                                            .replace('lambda x, i', 'lambda hit, i')
                                            .replace('length(x)', 'length(hit)').replace("'text': x", "'text': hit")}) AS part
        FROM judged WHERE NOT ok),
    parts AS (
        SELECT rid, first + part.start AS start, first + part.finish AS finish, part.text AS x FROM halves),
    spans AS (
        SELECT rid, list({{'start': start::BIGINT, 'kind': 3, 'finish': finish::BIGINT, 'ok': true}}) AS added
        FROM (SELECT rid, start, finish FROM judged WHERE ok
              UNION ALL SELECT rid, start, finish FROM parts WHERE {_SUSPICIOUS})
        GROUP BY rid)
    SELECT doc_id, len(assign)::BIGINT AS n_assign, len(access)::BIGINT AS n_access, len(hex)::BIGINT AS n_hex,
           sha256({_joined('base')}) AS base_sha256, {_joined('list_concat(base, coalesce(added, []))')} AS spans
    FROM merged LEFT JOIN spans USING (rid)
"""

_MIXING = """
    WITH RECURSIVE counts AS (
        SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5::DOUBLE) AS weight FROM documents GROUP BY source),
    means AS (
        SELECT source, weight / (SELECT sum(weight) FROM counts)
                       * (SELECT count(*)::DOUBLE FROM documents) / n AS mean FROM counts),
    rates AS (
        SELECT source, greatest(ceil(mean / 64.0::DOUBLE), 1)::INTEGER AS parts,
               mean / greatest(ceil(mean / 64.0::DOUBLE), 1) AS mean FROM means),
    tables AS (
        SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS reached FROM rates
        UNION ALL
        SELECT source, mean, k + 1, p * mean / (k + 1), reached + p * mean / (k + 1) FROM tables
        WHERE k < ceil(mean + 12 * sqrt(mean) + 24)),
    draws AS (
        SELECT d.doc_id, d.source, part,
               ('0x' || substr(md5(concat_ws(':', 'mixture', coalesce(d.source, ''),
                                             coalesce(d.doc_id::VARCHAR, ''), part::VARCHAR)), 1, 13))::BIGINT
               / 4503599627370496.0::DOUBLE AS at
        FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source,
             unnest(range(1, r.parts + 1)) AS u(part)),
    drawn AS (
        SELECT doc_id, count(*)::INTEGER AS copies
        FROM draws d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source AND t.reached <= d.at
        GROUP BY doc_id)
    SELECT d.*, c.copy::INTEGER AS copy, n.copies
    FROM documents d JOIN drawn n USING (doc_id), unnest(range(1, n.copies + 1)) AS c(copy)
"""

_LINES = r"""
    WITH texts AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    placed AS (
        SELECT doc_id, place, lines[place] AS line,
               translate(regexp_replace(lines[place], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM texts, unnest(range(1, len(lines) + 1)) AS t(place)),
    held AS (
        SELECT key, count(DISTINCT doc_id) AS documents, max(doc_id) AS top
        FROM placed WHERE length(key) >= 40 GROUP BY key),
    judged AS (
        SELECT p.*, coalesce(h.documents >= 5 AND p.doc_id <> h.top, false) AS gone
        FROM placed p LEFT JOIN held h ON p.key = h.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
"""

_FILTERS = r"""
    WITH RECURSIVE orders AS (
        SELECT ''::VARCHAR AS o, 0 AS done, []::INTEGER[] AS befores
        UNION ALL
        SELECT o || f, done | (1 << (ascii(f) - 65)), list_append(befores, done)
        FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS t(f) WHERE NOT contains(o, f)),
    steps AS (
        SELECT o, step::INTEGER AS step, substr(o, step, 1) AS letter,
               1 << (ascii(substr(o, step, 1)) - 65) AS own, befores[step] AS before
        FROM orders, unnest(range(1, 6)) AS t(step) WHERE length(o) = 5),
    texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS value FROM documents),
    measured AS (
        SELECT *, list_filter(string_split_regex(value, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
               doc_id > min(doc_id) OVER (PARTITION BY value) AS copied
        FROM texts),
    named AS (
        SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
    cells AS (
        SELECT part,
               (len(words) < 200)::INTEGER + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
               + 4 * (100 * length(regexp_replace(value, '[^A-Z]', '', 'g')) > 2 * length(value))::INTEGER
               + 8 * regexp_matches(value, '[#$%&*|]')::INTEGER + 16 * coalesce(copied, false)::INTEGER AS mask,
               count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
        FROM measured LEFT JOIN named USING (doc_id) GROUP BY ALL),
    counted AS (
        SELECT part, o AS filter_order, step, letter,
               coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
        FROM cells, steps GROUP BY ALL)
    SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counted
"""

ORACLE: dict[str, str] = {
    "op1_warc": _WARC,
    "op2_exact_dedup": _EXACT,
    "op6_fingerprints": _FINGERPRINTS,
    "op7_secrets": _SECRETS,
    "op8_mixing": _MIXING,
    "op11_line_dedup": _LINES,
    "op13_filter_audit": _FILTERS,
}
