"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others have none: sampled joins, suffix order, tokenizers, fitted models and
wrappers are compared with brute force in the tests.
"""

from __future__ import annotations

from ledgermill.llm import licenses as lic
from ledgermill.llm import line_dedup as ld
from ledgermill.llm import line_quality as lq
from ledgermill.llm import prefix_trie as pt
from ledgermill.llm.queries import MIX_POWER

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

_LINES = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS no_source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS ws FROM d)),
threes AS (SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS three
           FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM threes WHERE three IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words
             FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS place FROM again) GROUP BY 1),
words AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY 1),
lines AS (SELECT doc_id, source, no_source, text, line, array_to_string(regexp_extract_all(
            translate(line, '{_UPPER}0123456789', '{_LOWER}0000000000'), '{_WORD}'), ' ') AS norm,
            list_sum(list_transform(regexp_extract_all(line, '{_WORD}'), lambda x: length(x))) AS chars
          FROM (SELECT *, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY 1),
hosts AS (SELECT source, no_source, count(DISTINCT text) AS texts FROM d GROUP BY ALL),
common AS (SELECT source, no_source, norm FROM (SELECT source, no_source, norm, count(DISTINCT text) AS docs FROM lines GROUP BY ALL)
           JOIN hosts USING (source, no_source) WHERE docs > {lq.LINE_DOCS} AND docs > texts * {lq.LINE_SHARE}),
kept AS (SELECT l.doc_id, sum(l.chars) AS left_chars FROM lines l ANTI JOIN common c
         ON l.source = c.source AND l.no_source = c.no_source AND l.norm = c.norm GROUP BY 1),
base AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(left_chars, 0) AS left_chars
         FROM d LEFT JOIN words USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN dups USING (doc_id)
         LEFT JOIN kept USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {lq.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {lq.REPEAT_PERCENT} AS base_failed,
  NOT (n_words < {lq.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {lq.REPEAT_PERCENT})
    AND left_chars >= word_chars * {lq.LEFT_SHARE} AS kept
FROM base"""

_EVERY = lic.PHRASES + lic.TEMPLATES
_BASE = len(lic.PHRASES)
_VALUES = ", ".join(f"({k}, '{text}', '{label}')" for k, (text, label) in enumerate(_EVERY))

_LICENSES = f"""
WITH t(template, words, label) AS (SELECT k, string_split(x, ' '), l FROM (VALUES {_VALUES}) v(k, x, l)),
sized AS (SELECT *, greatest(1, len(words) - {lic.GRAM - 1}) AS windows, len(words) < {lic.GRAM} AS two FROM t),
grams AS (SELECT template, pos, words[pos + 1] AS w1, words[pos + 2] AS w2, CASE WHEN NOT two THEN words[pos + 3] END AS w3
          FROM (SELECT *, unnest(range(windows)) AS pos FROM sized)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
each AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS place FROM d),
three AS (SELECT doc_id, place, w, lead(w, 1) OVER o AS second, lead(w, 2) OVER o AS third
          FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
hits AS (SELECT doc_id, template, pos, place FROM three JOIN grams ON w = w1 AND second = w2 AND (w3 IS NULL OR third = w3)),
votes AS (SELECT doc_id, template, place - pos AS diagonal, count(DISTINCT pos) AS votes, min(place) AS low, max(place) AS high
          FROM hits GROUP BY ALL),
cuts AS (SELECT *, CASE WHEN template >= {_BASE} AND diagonal - lag(diagonal) OVER o <= {lic.DRIFT}
           AND low - lag(high) OVER o <= {lic.NEAR_WORDS} AND lag(low) OVER o - high <= {lic.NEAR_WORDS} THEN 0 ELSE 1 END AS new
         FROM votes WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
merged AS (SELECT doc_id, template, sum(votes) AS votes, min(low) AS low, max(high) AS high FROM (
             SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM cuts)
           GROUP BY doc_id, template, span),
spans AS (SELECT doc_id, template, low, label, least(votes / windows, 1.0) AS cover,
            template < {_BASE} AS is_base, template >= {_BASE} AND least(votes / windows, 1.0) >= {lic.COVER}
              AND high - low + 1 <= windows * {lic.LONGER} AS is_match
          FROM merged JOIN sized USING (template)),
found AS (SELECT doc_id, count(*) FILTER (WHERE is_base) AS n_base, min(low) FILTER (WHERE is_base) AS first_word,
            max(low) FILTER (WHERE is_base) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base OR is_match) AS labels,
            max(CASE WHEN is_base THEN 1.0 ELSE cover END) AS score
          FROM spans GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN found USING (doc_id)"""

_MIX = f"""
WITH sizes AS (SELECT coalesce('=' || source, 'null') AS s, CAST(coalesce(sum(strlen(text)), 0) AS DOUBLE) AS bytes
               FROM documents GROUP BY 1),
totals AS (SELECT sum(bytes) AS total, sum(CASE WHEN bytes > 0 THEN pow(bytes, {MIX_POWER}) ELSE 0 END) AS weights FROM sizes),
rates AS (SELECT s, CASE WHEN bytes > 0 THEN total * pow(bytes, {MIX_POWER}) / weights / bytes ELSE 1.0 END AS rate
          FROM sizes, totals),
steps AS (SELECT s, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY s ORDER BY k) AS reached
          FROM rates, (SELECT unnest(range(0, 200)) AS k)),
tables AS (SELECT s, list(reached) AS steps FROM steps GROUP BY 1),
counted AS (SELECT d.*, len(list_filter(steps, lambda x: x <= CAST('0x' || substr(md5(
              'mix|1|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0)) AS n
            FROM documents d JOIN tables ON coalesce('=' || source, 'null') = s)
SELECT * EXCLUDE (n), CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM counted"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS line_key FROM l),
common AS (SELECT line_key, max(doc_id) AS last FROM k WHERE length(line_key) >= {ld.LEAST_CHARS} GROUP BY 1
           HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'null')) >= {ld.LEAST_DOCS}),
marked AS (SELECT r, pos, line, last IS NOT NULL AND (doc_id IS NULL OR doc_id < last) AS gone FROM k LEFT JOIN common USING (line_key)),
put AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY 1)
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM d JOIN put USING (r)"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_prepend(xor({0}, {1}), range(8)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda s, b: {bits.format('s', 'b')}), 4294967295)"


# The states of the written turns are 0 nothing, 1 system, 2 user, 3 assistant; each state of a row holds
# the best (cost, letters, repaired lines) from there to the end.
def _best(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"


def _way(when: str, cost: str, letter: str, line: str, rest: str) -> str:
    lines = f"list_prepend({line}, {rest}.lines)" if line else f"{rest}.lines"
    return (f"CASE WHEN {when} AND {rest} IS NOT NULL THEN {{'cost': {rest}.cost + {cost}, "
            f"'letters': '{letter}' || {rest}.letters, 'lines': {lines}}} END")  # fmt: skip


_LEADS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def _row_states() -> str:
    out = []
    for q, leads in _LEADS.items():
        written = 3 if q == 2 else 2
        name = "assistant:" if q == 2 else "user:"
        ways = [_way("true", "2", "D", "", f"q{q}"), _way("NOT forced", "1 + more", "R", f"'{name}' || text", f"q{written}")]
        ways += [_way(f"NOT forced AND initial = '{c}'", "more", "K", "role || ':' || text", f"q{to}") for c, to in leads.items()]
        out.append(f"{_best(*ways)} AS p{q}")
    return ", ".join(out)


def _inserted(base: str) -> str:
    out = []
    for q in _LEADS:
        written, name = (3, "assistant:") if q == 2 else (2, "user:")
        out.append(_best(f"{base}{q}", _way("true", "5", "I", f"'{name}'", f"{base}{written}")) + f" AS q{q}")
    return ", ".join(out)


_GOAL = "{'cost': CAST(0 AS BIGINT), 'letters': '', 'lines': CAST([] AS VARCHAR[])}"
_NONE = f"CASE WHEN false THEN {_GOAL} END"

_REPAIR = f"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault FROM conversations),
hurt AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS again FROM raw WHERE fault <> 0),
placed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), 'null') AS c, row_number() OVER o AS i, left(role, 1) AS initial,
             trim(text, {_BLANKS}) AS solid, lag(left(role, 1)) OVER o AS before,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) AS time
           FROM hurt WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again)),
faults AS (SELECT *, solid = '' AS blank, solid <> '' AND time > 1 AS duplicate,
             solid <> '' AND time = 1 AND right(solid, 1) NOT IN ('.', '!', '?') AS truncated FROM placed),
counted AS (SELECT c, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
              count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
              count(*) FILTER (WHERE truncated) AS truncated,
              count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
            FROM faults GROUP BY 1),
steps AS (
  SELECT c, n + 1 AS i, {_inserted("p")} FROM (SELECT c, n, {_GOAL} AS p0, {_NONE} AS p1, {_NONE} AS p2, {_GOAL} AS p3 FROM counted)
  UNION ALL
  SELECT c, i, {_inserted("p")} FROM (SELECT c, r.i, {_row_states()} FROM steps JOIN
    (SELECT c, i, role, text, initial, blank OR duplicate AS forced, CASE WHEN truncated THEN 5 ELSE 0 END AS more FROM faults) r
    USING (c) WHERE r.i = steps.i - 1)),
best AS (SELECT c, q0 FROM steps WHERE i = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(q0.cost, 0) AS cost,
  coalesce(q0.letters, '') AS audit, sha256(coalesce(array_to_string(q0.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), 'null') AS c FROM conversations)
LEFT JOIN counted USING (c) LEFT JOIN best USING (c)"""

_TRIE = f"""
WITH turns AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS ts
               FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
cut AS (SELECT *, {_crc32("CAST(conv_id AS VARCHAR)")} % {pt.HEAD + 1} AS h FROM turns),
built AS (SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1:c.h], c.ts[c.h + 1:]) AS ts
          FROM cut c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (SELECT conv_id, len(ts) AS n, unnest(range(len(ts) + 1)) AS depth, ts FROM built),
marked AS (SELECT conv_id, n, depth, md5(CAST(ts[1:depth] AS VARCHAR)) AS node, md5(CAST(ts[1:depth - 1] AS VARCHAR)) AS up,
             CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(ts[depth].t, '{_WORD}')) END AS words FROM members),
nodes AS (SELECT depth, node, any_value(CASE WHEN depth > 0 THEN up END) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
          FROM marked GROUP BY 1, 2),
kids AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
inside AS (SELECT DISTINCT a.depth, a.node, b.depth AS at, b.node AS below FROM marked a JOIN marked b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (SELECT i.depth, i.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
         FROM inside i JOIN nodes b ON b.depth = i.at AND b.node = i.below LEFT JOIN kids k ON k.depth = i.at AND k.node = i.below GROUP BY 1, 2)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.up
LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node JOIN sums s ON s.depth = n.depth AND s.node = n.node"""

ORACLE: dict[str, str] = {
    "op5_line_frequency": _LINES,
    "op6_license_diagonals": _LICENSES,
    "op9_poisson_mix": _MIX,
    "op11_auction_repair": _REPAIR,
    "op12_prefix_ranges": _TRIE,
    "op13_line_dedup": _LINE_DEDUP,
}
