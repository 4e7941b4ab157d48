"""SQL for DuckDB where an operator's result can be said in SQL; exact and without the operators' methods."""

from __future__ import annotations

from . import quality, sentence_spans

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def op6() -> str:
    said = "'\\### Assistant: </turn> ok'"
    escaped = "regexp_replace(regexp_replace(text, '(\\\\*)(### |</turn>)', '\\1\\1\\\\\\2', 'g'), '(\\\\+)$', '\\1\\1')"
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-7, 0, 'user', {said}), (-7, 1, 'assistant', {said}))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' {order}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(14 + length(role) + length({escaped})) AS BIGINT) AS formatted_chars FROM turns GROUP BY conv_id"""


def op8(k: int = 3, percent: int = 85) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({lowered}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: {run})) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)"""


def op9() -> str:
    blank, dense = "chr(32) || chr(9) || chr(13) || chr(10)", "\\x{0E00}-\\x{0FFF}\\x{1000}-\\x{109F}\\x{1780}-\\x{17FF}\\x{3041}-\\x{30FF}\\x{3400}-\\x{9FFF}\\x{F900}-\\x{FAFF}"
    weight = lambda t: f"(len(string_split({t}, ' ')) + length({t}) - length(regexp_replace({t}, '[{dense}]', '', 'g')))"
    white = "[ \\t\\r\\n]"
    token = f"{white}*(?:[{dense}]|[^ \\t\\r\\n{dense}]+){white}*|{white}+"
    span, words = sentence_spans.SPAN, sentence_spans.WORDS
    return f"""WITH l AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '(\\n|[.!?][ \\t]|[。！？])', '\\1' || chr(1), 'g'), chr(1)) AS l FROM documents),
s AS (SELECT doc_id, unnest(l) AS s, unnest(range(1, len(l) + 1)) AS i FROM l),
k AS (SELECT doc_id, i, unnest(t) AS t, unnest(range(1, len(t) + 1)) AS k FROM (SELECT doc_id, i, CASE WHEN {weight(f"trim(s, {blank})")} > {sentence_spans.LONG} THEN regexp_extract_all(s, '{token}') ELSE [s] END AS t FROM s)),
m AS (SELECT *, coalesce(sum(CASE WHEN contains('{sentence_spans.CHOSEN}', md5(trim(t, {blank}))[1]) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, i ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m FROM k),
p AS (SELECT doc_id, piece, row_number() OVER (PARTITION BY doc_id ORDER BY i, m) AS o FROM (SELECT doc_id, i, m, string_agg(t, '' ORDER BY k) AS piece FROM m GROUP BY doc_id, i, m)),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS j, {weight("s")} AS w FROM (SELECT doc_id, o, trim(piece, {blank}) AS s FROM p) WHERE s <> ''),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY j) AS c FROM f),
e AS (SELECT a.doc_id, a.j, a.o, min(b.j) AS e, min(b.o) AS until FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.j BETWEEN a.j + {span - 1} AND a.j + {max(span, words) - 1} AND b.c - a.c + a.w >= {words} GROUP BY a.doc_id, a.j, a.o),
r AS (SELECT e.*, array_to_string(list_slice(x.x, e.j, e.e), chr(1)) AS run FROM e JOIN (SELECT doc_id, list(s ORDER BY j) AS x FROM f GROUP BY doc_id) x USING (doc_id)),
later AS (SELECT doc_id, o, until FROM r QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, j) > 1),
gone AS (SELECT DISTINCT p.doc_id, p.o FROM later JOIN p ON p.doc_id = later.doc_id AND p.o BETWEEN later.o AND later.until),
kept AS (SELECT p.doc_id, string_agg(p.piece, '' ORDER BY p.o) FILTER (WHERE g.o IS NULL) AS text, count(g.o) FILTER (WHERE trim(p.piece, {blank}) <> '') AS n_removed FROM p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.o = p.o GROUP BY p.doc_id)
SELECT d.doc_id, CASE WHEN k.n_removed = 0 THEN d.text ELSE coalesce(k.text, '') END AS text, k.n_removed FROM documents d JOIN kept k USING (doc_id)"""


def op10(keep_at: float = 0.25) -> str:
    n = len(quality.RULES)
    plain = lambda sql: sql.replace("D *", " *")
    votes = ", ".join(f"CASE WHEN {plain(bad)} THEN -1 WHEN {plain(good)} THEN 1 ELSE 0 END" for bad, good in quality.RULES.values())
    rate = lambda first, hit, share, r: f"least(0.99, greatest(0.01, ({2 * first} + sum(CASE WHEN v[{r}] = {hit} THEN n * {share} ELSE 0.0 END) OVER ()) / (2.0 + sum(CASE WHEN v[{r}] = 0 THEN 0.0 ELSE n * {share} END) OVER ())))"
    rates = ", ".join(f"{rate(quality.FIRST_GOOD, 1, 'p', r)} AS g{r}, {rate(quality.FIRST_BAD, -1, '(1.0 - p)', r)} AS b{r}" for r in range(1, n + 1))
    weights = " + ".join(f"CASE v[{r}] WHEN 1 THEN ln(g{r} / (1.0 - greatest(b{r}, 1.0 - g{r}))) WHEN -1 THEN ln((1.0 - g{r}) / greatest(b{r}, 1.0 - g{r})) ELSE 0.0 END" for r in range(1, n + 1))
    return f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM again, range(3) t(o) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
 len(lines) AS n_lines, length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_capitals, length(t) - length(regexp_replace(t, '[.!?]', '', 'g')) AS n_marks FROM w LEFT JOIN covered c USING (doc_id)),
voted AS MATERIALIZED (SELECT *, [{votes}] AS v FROM m),
em AS (SELECT 0 AS step, v, CAST(count(*) AS DOUBLE) AS n, 1.0 / (1.0 + exp(2.0 * len(list_filter(v, lambda x: x = -1)) - 2.0)) AS p FROM voted GROUP BY v
 UNION ALL SELECT step + 1, v, n, 1.0 / (1.0 + exp(-(ln(prior / (1.0 - prior)) + {weights}))) FROM (SELECT *, least(0.95, greatest(0.05, (1.0 + sum(n * p) OVER ()) / (2.0 + sum(n) OVER ()))) AS prior, {rates} FROM em WHERE step < {quality.ITERATIONS}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND em.p >= {keep_at} AS kept FROM voted JOIN em ON em.step = {quality.ITERATIONS} AND em.v = voted.v"""
