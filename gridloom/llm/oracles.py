"""The numbered queries in SQL, where SQL can say them: plain statements of what is computed."""

from __future__ import annotations

from .mixing import BLOCK, BLOCKS
from .quality import ERROR, LEAST_WORDS, MOST_REPEATED, RISK, RULES, STEPS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIX = f"""
WITH docs AS (
    SELECT doc_id, source, len({_WORDS}) AS size, substr(md5('0:' || doc_id), 1, 12) AS h FROM documents),
sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM docs GROUP BY source),
ranked AS (SELECT *, CAST([5, 2, 1][k % 3 + 1] AS DOUBLE) AS weight FROM sums),
levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
    FROM ranked WINDOW w AS (ORDER BY source_size / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT *, level * weight <= 3 * source_size AS free FROM levels),
targets AS (
    SELECT *, CASE WHEN free THEN (SELECT arg_min(level, (source_size / weight, k)) FROM free WHERE free) * weight ELSE 3 * source_size END AS target FROM free),
-- as many slots, a power of two, as make one no longer than 4096 words and than 1 / 1024 of the mean source
size_of AS (SELECT sum(source_size) AS words, greatest(1, least({BLOCK}, sum(source_size) // (greatest(1, count(*)) * {BLOCKS}))) AS block FROM sums),
counts AS (SELECT CAST(ceil(log2(words / block)) AS INT) AS m, words / 2 ** ceil(log2(words / block)) AS share FROM size_of),
edges AS (SELECT k, source_size, coalesce(lag(hi) OVER (ORDER BY k), 0) AS lo, hi FROM (SELECT k, source_size, sum(target) OVER (ORDER BY k) / sum(target) OVER () AS hi FROM targets WHERE target > 0)),
points AS (
    SELECT i AS slot, (SELECT sum(((i >> b) & 1) / 2.0 ** (b + 1)) FROM range(48) AS r(b)) AS point
    FROM (SELECT unnest(range(CAST(2 ** m AS BIGINT))) AS i FROM counts)),
won AS (SELECT k, slot, row_number() OVER (PARTITION BY k ORDER BY slot) - 1 AS rank FROM points ASOF JOIN edges ON point >= lo),
gives AS (SELECT k, least(floor(count(*) * any_value(share)), 3 * any_value(source_size)) AS most FROM won JOIN edges USING (k), counts GROUP BY k),
line AS (
    SELECT d.doc_id, k, size, source_size, coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
passes AS (SELECT doc_id, k, p * source_size + place AS lo, least(p * source_size + place + size, most) AS hi FROM line JOIN gives USING (k), range(3) AS r(p)),
pieces AS (SELECT doc_id, k, lo, hi, unnest(range(CAST(greatest(floor(lo / share) - 1, 0) AS BIGINT), CAST(floor(hi / share) AS BIGINT) + 2)) AS rank FROM passes, counts WHERE hi > lo),
taken AS (
    SELECT doc_id, slot, least(hi, floor((rank + 1) * share)) - greatest(lo, floor(rank * share)) AS words
    FROM pieces JOIN won USING (k, rank), counts WHERE least(hi, floor((rank + 1) * share)) > greatest(lo, floor(rank * share)))
SELECT d.doc_id, size, t.source_size, target, CAST(coalesce(sum(words), 0) AS BIGINT) AS taken, min(slot) AS first_slot, count(DISTINCT slot) AS n_slots
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN taken USING (doc_id) GROUP BY ALL"""

NEAR = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM words),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, y) AS component_id, doc_id = least(doc_id, y) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON x = doc_id"""

# the steps of the cutoffs that reject a text, in turn through the rules
_STEPS = ", ".join(f"CASE WHEN {rule} > {cut} THEN {i * len(RULES) + r} END" for r, (rule, cuts) in enumerate(RULES.items()) for i, cut in enumerate(cuts))

QUALITY = f"""
WITH words AS (SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 2]) AS times FROM places),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(3) AS r(k) WHERE times > 1 GROUP BY doc_id),
counts AS (
    SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0) AS n_repeat_words,
           length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks, length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals
    FROM (SELECT *, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM words) LEFT JOIN covered USING (doc_id)),
ratios AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
           coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word, coalesce(n_marks / nullif(n_words, 0), 0) AS marks_per_word,
           coalesce(n_capitals / nullif(word_chars, 0), 0) AS capitals_per_char, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS repeated_lines,
           coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeated_words
    FROM counts),
stepped AS (SELECT *, least({_STEPS}) AS step FROM ratios),
good AS (SELECT lang, CASE WHEN NOT base_failed THEN step END AS step FROM stepped WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
strata AS (SELECT count(DISTINCT coalesce(lang, '')) AS s FROM good),
stops AS (SELECT lang, step, count(*) AS rows FROM good GROUP BY ALL),
tests AS (SELECT lang, t, CAST(sum(rows) AS BIGINT) AS n, CAST(coalesce(sum(rows) FILTER (WHERE step <= t), 0) AS BIGINT) AS k FROM stops, range({STEPS}) AS r(t) GROUP BY lang, t),
valid AS (
    SELECT *, (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK}))) FROM range(k + 1) AS r(i)) <= {ERROR} / s AS ok
    FROM tests, strata),
passed AS (SELECT lang, t, bool_and(ok) OVER (PARTITION BY lang ORDER BY t) AS every FROM valid),
chosen AS (SELECT lang, max(t) AS t FROM passed WHERE every GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(step <= t, false) AS kept
FROM stepped x LEFT JOIN chosen c ON x.lang IS NOT DISTINCT FROM c.lang"""

QUOTES = """
SELECT conv_id, turn, lag(turn) OVER w AS parent_turn, first_value(turn) OVER w AS root_turn, row_number() OVER w - 1 AS depth, sha256(text) AS text_sha256
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""


def _clusters(rounds: int = 10, k: int = 8) -> str:
    """A step of assigning and a step of averaging for each round."""
    distance = "CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x, c)]) AS BIGINT)"
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT) FOR v IN embedding] AS x
    FROM embeddings WHERE len(embedding) = 64 AND len([v FOR v IN embedding IF v IS NOT NULL AND isfinite(v)]) = 64),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x AS c
    FROM (SELECT *, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept ORDER BY h, x LIMIT {k}))"""
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT r, k, {distance} AS d FROM kept CROSS JOIN c{i}) GROUP BY r)")
        if i < rounds:
            steps.append(f"""m{i} AS (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
    FROM (SELECT k, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (SELECT k, unnest(x) AS v, unnest(range(64)) AS i FROM a{i} JOIN kept USING (r)) GROUP BY k, i) GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} m USING (k))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(k AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} USING (k)"""


CLUSTERS = _clusters()
