"""DuckDB SQL for the queries that SQL can express, one string per query, by its name."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality() -> str:
    from pingline.llm import quality

    rules = quality.RULES
    alpha, share = quality.LIMIT / len(rules), quality.DELTA / len(rules)
    cutoffs = ", ".join(
        f"({i}, '{r.name}', {j}, {c})" for i, r in enumerate(rules) for j, c in enumerate(r.cutoffs()))
    reject = "CASE c.rule " + " ".join(
        f"WHEN {i} THEN 1000 * h.{r.top} {r.compare} c.cutoff * h.{r.bottom}" for i, r in enumerate(rules)) + " END"
    return rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS} AS words,
                  row_number() OVER () AS row FROM documents),
starts AS (SELECT row, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5),
windows AS (SELECT s.row, i, list_slice(words, i, i + 4) AS win FROM starts s JOIN w USING (row)),
often AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, win) > 1),
repeated AS (SELECT row, count(DISTINCT i + k) AS n FROM often, range(0, 5) AS r(k) GROUP BY row),
counts AS (
  SELECT doc_id, lang AS stratum, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeated USING (row)),
c AS (
  SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
holdout AS (
  SELECT c.* FROM c JOIN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL
    GROUP BY doc_id HAVING min(quality) = 1) USING (doc_id) WHERE NOT base_failed),
cutoffs(rule, name, place, cutoff) AS (VALUES {cutoffs}),
tests AS (
  SELECT stratum, rule, place, cutoff, count(*) AS n, count(*) FILTER ({reject.replace('c.', 'x.')}) AS k
  FROM holdout h, cutoffs x GROUP BY ALL),
level AS (SELECT {share!r} / count(DISTINCT coalesce(stratum, '<none>')) AS level FROM holdout),
passed AS (
  SELECT stratum, rule, place, cutoff, k < n * {alpha!r} AND
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({alpha!r}) + (n - i) * ln(1 - {alpha!r})))) <= level AS ok
  FROM tests, level),
unbroken AS (SELECT * FROM passed QUALIFY bool_and(ok) OVER (PARTITION BY stratum, rule ORDER BY place)),
best AS (SELECT stratum, rule, max_by(cutoff, place) AS cutoff FROM unbroken GROUP BY ALL),
rejected AS (
  SELECT DISTINCT h.doc_id, h.n_words, h.word_chars, h.n_symbols, h.n_repeat_words, h.stratum
  FROM c h JOIN best c ON h.stratum IS NOT DISTINCT FROM c.stratum WHERE NOT base_failed AND {reject})
SELECT c.doc_id, c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, base_failed,
  NOT base_failed AND r.n_words IS NULL AS kept
FROM c LEFT JOIN rejected r ON c.doc_id IS NOT DISTINCT FROM r.doc_id AND c.n_words = r.n_words
  AND c.word_chars = r.word_chars AND c.n_symbols = r.n_symbols AND c.n_repeat_words = r.n_repeat_words
  AND c.stratum IS NOT DISTINCT FROM r.stratum
"""


op4_quality = _quality()

op10_exact_dedup = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row,
  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, row) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""


def _chat() -> str:
    from pingline.llm.chat import INSTRUCT

    first, rest = INSTRUCT.pattern()
    escaped = "regexp_replace({}, '(%s)(\\\\*)(%s)', '\\1\\\\\\2\\3', 'g')" % (first, rest)
    marks = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in INSTRUCT.marks.items())
    other = sum(map(len, INSTRUCT.other))
    known = ", ".join(f"'{r}'" for r in INSTRUCT.marks)
    loss = ", ".join(f"'{r}'" for r in sorted(INSTRUCT.loss))
    moves = ", ".join(f"('{s}', '{r}', '{t}')" for (s, r), t in INSTRUCT.moves.items())
    # states by the role before: the machine's state after a legal prefix
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM given),
moves(state, role, goes) AS (VALUES {moves}),
walk(conv_id, place, state, bad) AS (
  SELECT DISTINCT conv_id, -1::BIGINT, 'start', NULL::BIGINT FROM t
  UNION ALL
  SELECT w.conv_id, w.place + 1, coalesce(m.goes, w.state), coalesce(w.bad, CASE WHEN m.goes IS NULL THEN w.place + 1 END)
  FROM walk w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.place = w.place + 1
  LEFT JOIN moves m ON m.state = w.state AND m.role = t.role),
ends AS (SELECT conv_id, max_by(state, place) AS state, min(bad) AS bad FROM walk GROUP BY conv_id),
sums AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role IN ({loss})), '') AS loss_text,
    sum(length({escaped.format('text')}) + CASE role {marks} ELSE {other} + length({escaped.format('role')}) END)::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT s.conv_id, n_turns, turns_sha256, length(loss_text) AS loss_chars, sha256(loss_text) AS loss_sha256, formatted_chars,
  bad IS NULL AS valid, bad IS NULL AND state = 'answered' AS complete, coalesce(bad, -1)::INT AS first_bad
FROM sums s JOIN ends e ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""


op2_chat = _chat()

op8_line_dedup = r"""
WITH p AS (
  SELECT page_id, regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)', 1), '^(www|m|blog)\.', '') AS host,
    string_split(regexp_replace(html, '(?s)<!--.*?-->|<[^>]*>', chr(10), 'g'), chr(10)) AS lines, row_number() OVER () AS row FROM pages),
l AS (SELECT DISTINCT row, host, regexp_replace(unnest(lines), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM p),
n AS (SELECT host, line, count(*) AS n FROM l WHERE line != '' GROUP BY ALL HAVING count(*) >= 2),
total AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
common AS (SELECT n.host, list(line) AS drops FROM n JOIN total t ON n.host IS NOT DISTINCT FROM t.host WHERE n.n > 0.3 * pages GROUP BY ALL),
k AS (
  SELECT page_id, p.host, lines, list_filter(lines, lambda x: NOT coalesce(list_contains(drops,
    regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')), false)) AS kept
  FROM p LEFT JOIN common c ON p.host IS NOT DISTINCT FROM c.host)
SELECT page_id, host, len(coalesce(lines, []))::BIGINT AS n_lines, (len(coalesce(lines, [])) - len(coalesce(kept, [])))::BIGINT AS n_dropped,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256 FROM k
"""


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

op12_lexical_search = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
lengths AS (SELECT row, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
items AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS terms FROM benchmark),
wanted AS (SELECT item, item_id, unnest(terms) AS term FROM items),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, docs),
room AS (SELECT row, doc_id, 100 - 90 + (90 * n * docs) // total AS m FROM lengths, whole),
scores AS (
  SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN room USING (row) GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
