"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force in tests/llm."""

from __future__ import annotations

from kgspark.llm.secrets import BASE, RULES

#: ASCII upper case to lower case, as the definitions want it: other letters stay.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = "((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"


def _secrets() -> str:
    """Spans from the pieces between matches, rule by rule, put together by start and rule."""
    parts = []
    for place, rule in enumerate(RULES):
        pattern = rule.pattern
        if rule.kind == "assign":
            pattern = _LETTERS + pattern[pattern.index("""["']?\\x20*[:=]""") :]
        pattern = pattern.replace("'", "''")
        parts.append(f"""
        SELECT row, {place} AS place, '{rule.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, p, v, {rule.least} AS least FROM (
            SELECT row, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {rule.group}) AS v,
                   string_split_regex(text, '{pattern}') AS p FROM d)""")
    kinds = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    base = ", ".join(f"'{k}'" for k in BASE)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    hits AS ({" UNION ALL ".join(parts)}),
    spans AS (
        SELECT row, place, kind, s, s + length(m[i]) AS e FROM (
            SELECT *, coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s
            FROM hits WHERE length(v[i]) >= least)),
    told AS (SELECT row, place, kind, s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS t FROM spans),
    summed AS (
        SELECT row, {kinds}, string_agg(t, ',' ORDER BY s, place) FILTER (kind IN ({base})) AS base, string_agg(t, ',' ORDER BY s, place) AS spans
        FROM told GROUP BY row)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN summed USING (row)"""


_PLAIN = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i+12], ' ') AS t
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
found AS (
    SELECT row, i, n, item_id FROM (SELECT row, i, n, array_to_string(w[i:i+n-1], ' ') AS t FROM places) JOIN windows USING (n, t)),
hit AS (SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT row, i, n FROM found)) GROUP BY row),
items AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE "C") AS names
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN items USING (row)"""

_ESCAPED = r"regexp_replace({0}, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')"

CHAT = f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + 5 + length({_ESCAPED.format("text")}) + 5) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

_RULES = {
    "base": "base_failed", "symbols": "10 * n_symbols > word_chars", "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
}

QUALITY = f"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (
    SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row),
windows AS (SELECT row, i, array_to_string(w[i:i+4], ' ') AS t FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, t) AS n FROM windows) WHERE n > 1),
inside AS (SELECT row, count(DISTINCT word) AS n FROM (SELECT row, unnest(range(i, i + 5)) AS word FROM again) GROUP BY row),
measured AS (
    SELECT row, doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words
    FROM d LEFT JOIN lines USING (row) LEFT JOIN inside USING (row)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
failures AS (SELECT source, {", ".join(f"({rule}) AS {name}" for name, rule in _RULES.items())} FROM judged WHERE source IS NOT NULL),
hosts AS (SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER ({name}) AS {name}" for name in _RULES)} FROM failures GROUP BY source),
moments AS (SELECT {", ".join(f"sum({n}) / sum(n) AS {n}_m, var_pop({n} / n) AS {n}_v" for n in _RULES)} FROM hosts),
priors AS (SELECT {", ".join(f"{n}_m, CASE WHEN {n}_v > 0 THEN least(greatest({n}_m * (1 - {n}_m) / {n}_v - 1, 1), 1e6) ELSE 1e6 END AS {n}_w" for n in _RULES)} FROM moments),
condemned AS (SELECT source FROM hosts, priors WHERE {" OR ".join(f"({n} + {n}_m * {n}_w) / (n + {n}_w) >= 0.5" for n in _RULES)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (source IS NOT NULL AND source IN (SELECT source FROM condemned) AND ({" OR ".join(f"({rule})" for name, rule in _RULES.items() if name != "base")})) AS kept
FROM judged"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
heads AS (SELECT html, max(page_id) AS head FROM p GROUP BY html),
bits AS (
    SELECT page_id, head, strlen(html) AS payload_bytes,
           array_to_string(list_transform(string_split(sha1(html), ''), lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') AS b
    FROM p JOIN heads USING (html))
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           16 * CAST(b[5*i+1] AS INT) + 8 * CAST(b[5*i+2] AS INT) + 4 * CAST(b[5*i+3] AS INT) + 2 * CAST(b[5*i+4] AS INT) + CAST(b[5*i+5] AS INT) + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id < head THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < head THEN head END AS refers_to
FROM bits"""

SHARDING = """
WITH k AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
levels AS (SELECT doc_id, bytes, h, unnest(range(0, 61)) AS depth FROM k),
summed AS (SELECT doc_id, bytes, h, depth, sum(bytes) OVER (PARTITION BY depth, h >> (60 - depth)) AS total FROM levels),
fit AS (SELECT doc_id, bytes, h, min(depth) AS depth FROM summed WHERE total <= 1048576 OR depth = 60 GROUP BY doc_id, bytes, h)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> (60 - depth)), CAST(depth AS INT), '0') END AS shard, CAST(depth AS INT) AS depth FROM fit"""

_TERMS = "regexp_extract_all({0}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

#: Every term against every group and every other source, as the definition reads; 128-bit integers throughout.
DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
said AS (SELECT row, lang, source, unnest(w) AS term FROM d),
vocabulary AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS b FROM said GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(b) AS HUGEINT) AS m FROM vocabulary GROUP BY lang),
counts AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS a FROM said SEMI JOIN vocabulary USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(a) AS n FROM counts GROUP BY lang, source),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (
    SELECT lang, source, term, coalesce(a, 0) AS a, 1 + 1000000000 * (coalesce(a, 0) + 2) // (coalesce(n, 0) + 2 * v) AS p, 1 + 1000000000 * (b + 2) // (m + 2 * v) AS q
    FROM groups JOIN langs USING (lang) JOIN vocabulary USING (lang) LEFT JOIN counts USING (lang, source, term) LEFT JOIN totals USING (lang, source)),
sums AS (
    SELECT l.lang, l.source, r.source AS item, sum((l.p - r.p) * (l.p - r.p) // (l.p + r.p)) AS value
    FROM cells l JOIN cells r ON l.lang = r.lang AND l.term = r.term AND l.source <> r.source GROUP BY ALL),
pairs AS (
    SELECT l.lang, l.source, 'pair' AS part, r.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups l JOIN groups r ON l.lang = r.lang AND l.source <> r.source LEFT JOIN sums ON sums.lang = l.lang AND sums.source = l.source AND sums.item = r.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM cells WHERE a > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C") AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

ORACLES: dict[str, str] = {
    "op3_secrets": _secrets(),
    "op5_decontaminate": DECONTAMINATE,
    "op7_chat": CHAT,
    "op8_quality": QUALITY,
    "op9_warc": WARC,
    "op10_sharding": SHARDING,
    "op13_divergence": DIVERGENCE,
}
