"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .chat import AGAIN, CLOSE, CONTROL, HEAD, OPEN
from .decontaminate import MASKS, SHARE, SPAN, WINDOW
from .licenses import EQUIVALENT, KNOWN, standard_notices
from .quality import RULES, STOP_WORDS

SQL: dict[str, str] = {}


def _fails(rule) -> str:
    parts = []
    if rule.low is not None:
        parts.append(f"{rule.metric} < {rule.low!r}")
    if rule.high is not None:
        parts.append(f"{rule.metric} > {rule.high!r}")
    cond = f"({' OR '.join(parts)}) AND n_words >= {rule.min_words}"
    return cond + (f" AND n_words <= {rule.max_words}" if rule.max_words is not None else "")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_FAILED = ", ".join(f"CASE WHEN {_fails(r)} THEN '{r.name}' END" for r in RULES)

SQL["op3_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT rid, i, array_to_string(ws[i : i + 7], ' ') AS win
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w)),
dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win) WHERE c > 1),
rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(generate_series(i, i + 7)) AS p FROM dup) GROUP BY rid),
ln AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, len(list_distinct(ws)) AS n_distinct_words,
         len(list_filter(ws, lambda x: x IN ({_STOP}))) AS n_stop_words
  FROM d JOIN w USING (rid) LEFT JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
r AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
         coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word,
         coalesce(n_upper / nullif(word_chars, 0), 0) AS upper_per_char,
         coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_ratio,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
         coalesce(n_distinct_words / nullif(n_words, 0), 0) AS distinct_ratio
  FROM m),
f AS (SELECT *, concat_ws(',', {_FAILED}) AS failed_rules FROM r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM f"""


def _seed_rows(source: str, key: str) -> str:
    parts = [f"SELECT {key}, i - 1 AS pos, {m} AS mask, concat_ws(' ', {', '.join(f'ws[i + {o}]' for o in mask)}) AS seed FROM "
             f"(SELECT {key}, ws, unnest(generate_series(1, len(ws) - {SPAN - 1})) AS i FROM {source})"
             for m, mask in enumerate(MASKS)]
    return " UNION ALL ".join(parts)


SQL["op7_benchmark_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS ws
  FROM (SELECT DISTINCT doc_id, text FROM documents)),
b AS (
  SELECT row_number() OVER () AS bid, item_id, ws
  FROM (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS ws FROM benchmark)),
ds AS ({_seed_rows('d', 'rid')}),
bs AS ({_seed_rows('b', 'bid')}),
h AS (SELECT DISTINCT rid, bid, ds.pos - bs.pos AS diag FROM ds JOIN bs USING (mask, seed)),
q AS (
  SELECT rid, bid, diag, p, (d.ws[p + diag] = b.ws[p])::INT AS eq, least({WINDOW}, len(b.ws)) AS w, len(b.ws) AS item_words
  FROM (SELECT rid, bid, diag, unnest(generate_series(greatest(1, 1 - diag), least(len(bw), len(dw) - diag))) AS p
        FROM (SELECT h.*, d.ws AS dw, b.ws AS bw FROM h JOIN d USING (rid) JOIN b USING (bid)))
  JOIN d USING (rid) JOIN b USING (bid)),
v AS (
  SELECT a.rid, a.bid, a.diag, a.p, a.w, a.item_words, count(*) AS n, sum(z.eq) AS e
  FROM q a JOIN q z ON a.rid = z.rid AND a.bid = z.bid AND a.diag = z.diag AND z.p BETWEEN a.p AND a.p + a.w - 1
  GROUP BY ALL),
g AS (SELECT rid, bid, diag, any_value(item_words) AS item_words, max(e) AS best FROM v WHERE n = w AND e >= {SHARE} * w GROUP BY ALL),
s AS (SELECT rid, bid, diag, sum(eq) AS n FROM q GROUP BY ALL)
SELECT doc_id, item_id, item_words::INT AS item_words, max(s.n)::INT AS equal_words, max(best)::INT AS window_equal
FROM g JOIN s USING (rid, bid, diag) JOIN d USING (rid) JOIN b USING (bid)
GROUP BY rid, bid, doc_id, item_id, item_words"""


def _escaped_length(column: str) -> str:
    """Every backslash and every control string gains one character."""
    more = " + ".join(f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROL))
    return f"(length({column}) + {more})"


SQL["op8_chat_formatting"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM t),
p AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM o),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn) AS said,
         coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '') AS loss,
         sum({_escaped_length('text')} + CASE WHEN before = role THEN {len(AGAIN)}
             ELSE {len(OPEN) + len(HEAD) + len(CLOSE)} + {_escaped_length('role')} END) AS formatted_chars
  FROM p GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars
FROM g"""


def _canonical(t: str) -> str:
    out = f"regexp_replace(lower(coalesce({t}, '')), '(?m)^[^\\p{{L}}\\p{{N}}\\n©]*(?:©|\\(c\\)|copyright\\b|all rights reserved\\b)[^\\n]*$', '', 'g')"
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for a, b in EQUIVALENT:
        out = f"regexp_replace({out}, '\\b{a}\\b', '{b}', 'g')"
    return out


def _canonical_digest(c: str) -> str:
    words = f"trim(regexp_replace({c}, '[ \\n]+', ' ', 'g'))"
    return f"CASE WHEN {words} <> '' THEN sha256({words}) END"


# the notices, the standard ones among them; full texts are compared in tests/llm
_KNOWN = ", ".join(f"('{n}', '{t}')" for n, t in (*KNOWN, *standard_notices()))

SQL["op1_license_scan"] = f"""
WITH k AS (
  SELECT {_canonical_digest('c')} AS digest, min(license) AS license
  FROM (SELECT license, {_canonical('text')} AS c FROM (VALUES {_KNOWN}) AS v(license, text)) GROUP BY 1),
c AS (SELECT row_number() OVER () AS rid, doc_id, {_canonical('text')} AS c FROM documents),
l AS (
  SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses
  FROM (SELECT rid, {_canonical_digest('line')} AS digest FROM (SELECT rid, unnest(string_split(c, chr(10))) AS line FROM c))
  JOIN k USING (digest) GROUP BY rid)
SELECT doc_id, digest, license, coalesce(line_licenses, '') AS line_licenses
FROM (SELECT rid, doc_id, {_canonical_digest('c')} AS digest FROM c) LEFT JOIN k USING (digest) LEFT JOIN l USING (rid)"""


def _base32(hexed: str) -> str:
    """Upper-case base32 of 40 hex digits."""
    parts = []
    for k in range(8):
        value = " + ".join(f"(instr('0123456789abcdef', substr({hexed}, {5 * k + i + 1}, 1)) - 1) * {16 ** (4 - i)}" for i in range(5))
        parts += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({value}) >> {shift}) & 31)::INT + 1, 1)" for shift in (15, 10, 5, 0)]
    return " || ".join(parts)


SQL["op4_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_base32('x')} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM m"""

SQL["op11_lexical_search"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM t),
tf AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM t) GROUP BY rid, term),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) CROSS JOIN s),
m AS (SELECT rid, doc_id, 25 + (75 * len(ts) * n_docs) // n_terms AS m FROM t CROSS JOIN s WHERE len(ts) > 0),
scored AS (
  SELECT item_id, rid, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY item_id, rid),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored JOIN m USING (rid) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

SQL["op12_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT rid, i, array_to_string(ws[i : i + 34], ' ') AS win
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM d)),
rep AS (SELECT rid, i FROM win WHERE win IN (SELECT win FROM win GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT rid, list(DISTINCT p) AS ps FROM (SELECT rid, unnest(generate_series(i, i + 34)) AS p FROM rep) GROUP BY rid),
words AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
cov AS (SELECT DISTINCT rid, unnest(ps) AS p FROM gone),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN cov USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""
