r"""DuckDB SQL for the queries that SQL can express on whole tables.

Each text works its result out from the contract with DuckDB's own functions;
of the operators it takes only the fixed values (license phrases and notices).
XXH64, tokenizers and fitted classifiers have no SQL; those queries are tested
against brute force, the libraries and held-out rows.
"""

from __future__ import annotations

from haulwise.llm.license_scan import NOTICES, PHRASES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _alnum(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}')"


SUBSTRING = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM docs),
windows AS (
  SELECT doc_id, p, string_agg(word, ' ') OVER run AS sequence, count(*) OVER run AS n FROM words
  WINDOW run AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
firsts AS (SELECT sequence, min(doc_id) AS low FROM windows WHERE n = 13 GROUP BY sequence),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM windows JOIN firsts USING (sequence)
  WHERE n = 13 AND low < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

CONTAMINATION = f"""
WITH item_words AS (
  SELECT item_id, unnest(ws) AS word, unnest(range(len(ws))) AS p, len(ws) AS size
  FROM (SELECT CAST(item_id AS VARCHAR) AS item_id, {_alnum('text')} AS ws FROM benchmark)),
item_runs AS (
  SELECT item_id, p, size, word, string_agg(word, ' ') OVER run AS sequence, count(*) OVER run AS n FROM item_words
  WINDOW run AS (PARTITION BY item_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
item_windows AS (SELECT DISTINCT item_id, word, sequence, n FROM item_runs WHERE n = 10 OR p = 0 AND size < 10),
docs AS (SELECT doc_id, {_alnum('text')} AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM docs),
runs AS (
  SELECT doc_id, p, word, string_agg(word, ' ') OVER run AS sequence FROM words
  WINDOW run AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
found AS (
  SELECT doc_id, p, w.n, item_id FROM runs JOIN item_windows w ON runs.sequence = w.sequence WHERE w.n = 10
  UNION ALL
  SELECT doc_id, p, w.n, item_id FROM runs JOIN item_windows w
    ON runs.word = w.word AND starts_with(runs.sequence || ' ', w.sequence || ' ') WHERE w.n < 10),
hits AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|'))
    + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE NOT isnan(list_cosine_similarity(a.x, b.x)) AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT reach.a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(b) AS component_id, min(b) = reach.a AS kept
FROM reach LEFT JOIN degree ON degree.a = reach.a GROUP BY reach.a"""


def _values(rows) -> str:
    return ", ".join(f"({i}, '{label}', '{text}')" for i, (text, label) in enumerate(rows))


LICENSES = f"""
WITH docs AS (SELECT doc_id, {_alnum('text')} AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM docs),
runs AS (
  SELECT doc_id, p, word, lead(word) OVER here AS second, lead(word, 2) OVER here AS third FROM words
  WINDOW here AS (PARTITION BY doc_id ORDER BY p)),
phrases AS (SELECT label, text, len(string_split(text, ' ')) AS n FROM (VALUES {_values(PHRASES)}) t(i, label, text)),
places AS (
  SELECT doc_id, p, label FROM runs JOIN phrases
    ON text = CASE n WHEN 2 THEN concat_ws(' ', word, second) ELSE concat_ws(' ', word, second, third) END),
notices AS (SELECT i, label, string_split(text, ' ') AS ws FROM (VALUES {_values(NOTICES)}) t(i, label, text)),
notice_words AS (SELECT i, label, len(ws) AS size, unnest(ws) AS word, unnest(range(len(ws))) AS slot FROM notices),
grams AS (
  SELECT *, lead(word) OVER here AS second, lead(word, 2) OVER here AS third FROM notice_words
  WINDOW here AS (PARTITION BY i ORDER BY slot)),
matched AS (
  SELECT DISTINCT doc_id, i, label, size, p, slot, true AS whole
  FROM runs JOIN grams ON runs.word = grams.word AND runs.second = grams.second AND runs.third = grams.third
  UNION ALL
  SELECT DISTINCT doc_id, i, label, size, p, slot, false
  FROM runs JOIN grams ON runs.word = grams.word AND runs.second = grams.second
  WHERE (size - 4) / (size - 2) < 0.8 AND (slot = 0 OR slot = size - 2)),
marked AS (
  SELECT *, CASE WHEN p - slot - lag(p - slot) OVER d <= greatest(4, size // 16) THEN 0 ELSE 1 END AS new
  FROM matched WINDOW d AS (PARTITION BY doc_id, i ORDER BY p - slot)),
chained AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, i ORDER BY p - slot RANGE UNBOUNDED PRECEDING) AS chain FROM marked),
single AS (
  SELECT DISTINCT doc_id, i, chain, size, unnest([p, p + 1, CASE WHEN whole THEN p + 2 ELSE p END]) AS p,
    unnest([slot, slot + 1, CASE WHEN whole THEN slot + 2 ELSE slot END]) AS slot
  FROM chained WHERE (size - 4) / (size - 2) < 0.8),
starts AS (
  SELECT a.doc_id, a.i, a.chain, a.p, count(DISTINCT b.slot) AS held
  FROM chained a JOIN chained b ON a.doc_id = b.doc_id AND a.i = b.i AND a.chain = b.chain
    AND b.p BETWEEN a.p AND a.p + floor(a.size * 1.3) - 3
  WHERE a.whole AND b.whole GROUP BY a.doc_id, a.i, a.chain, a.p),
single_starts AS (
  SELECT a.doc_id, a.i, a.chain, a.p, count(DISTINCT b.slot) AS held
  FROM single a JOIN single b ON a.doc_id = b.doc_id AND a.i = b.i AND a.chain = b.chain
    AND b.p BETWEEN a.p AND a.p + floor(a.size * 1.3) - 1
  GROUP BY a.doc_id, a.i, a.chain, a.p),
fullest AS (SELECT doc_id, i, chain, max(held) AS held FROM starts GROUP BY ALL),
fullest_words AS (SELECT doc_id, i, chain, max(held) AS held FROM single_starts GROUP BY ALL),
merged AS (
  SELECT c.doc_id, any_value(c.label) AS label, count(DISTINCT slot) / (any_value(size) - 2) AS met,
    any_value(f.held) / (any_value(size) - 2) AS cover,
    any_value(f.held) / (any_value(size) - 2) >= 0.8 OR coalesce(any_value(w.held) = any_value(size), false) AS sure
  FROM chained c JOIN fullest f USING (doc_id, i, chain) LEFT JOIN fullest_words w USING (doc_id, i, chain)
  WHERE whole GROUP BY c.doc_id, i, chain HAVING count(DISTINCT slot) >= 3),
found AS (
  SELECT doc_id, label, true AS base, true AS sure, 1.0::DOUBLE AS score, p FROM places
  UNION ALL
  SELECT doc_id, label, false, sure, CASE WHEN sure THEN cover ELSE met * 0.5 END, NULL FROM merged),
summed AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(p) AS first_word, max(p) AS last_word, max(score) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (sure) AS labels
  FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM docs LEFT JOIN summed USING (doc_id)"""

#: All pairs of equal words of a text, islands of their diagonals, and CRC-32 bit by bit.
PERIODIC = r"""
WITH numbered AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS given,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, unused: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS h
  FROM documents),
placed AS (SELECT *, len(given) AS n, (h // 10) % greatest(len(given), 1) AS a, 3 + (h // 10) % 8 AS e FROM numbered),
docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: given[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // e) END + 1])
    ELSE given END AS ws
  FROM placed),
words AS (SELECT doc_id, n, unnest(ws) AS word, unnest(range(n)) AS i FROM docs),
matches AS (
  SELECT x.doc_id, x.i - y.i AS lag, x.i FROM words x JOIN words y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND x.n >= 24 AND 3 * (x.i - y.i) <= x.n),
diagonals AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM matches),
stretches AS (
  SELECT doc_id, lag, min(i) - lag AS start, max(i) + 1 AS stop FROM diagonals GROUP BY doc_id, lag, island
  HAVING count(*) + lag >= greatest(24, 3 * lag)),
runs AS (SELECT doc_id, start, stop - start AS length, min(lag) AS period FROM stretches GROUP BY doc_id, start, stop),
best AS (
  SELECT * FROM runs x WHERE NOT EXISTS (
    SELECT 1 FROM runs y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period
      OR y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period)))),
lines AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS text
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT docs.doc_id, coalesce(lines.n_runs, 0) AS n_runs, CAST(best.start AS BIGINT) AS start,
  CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
  CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN lines USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""

#: One running sum per source; a source is full if its share, once all sources that fill up sooner have, reaches its limit.
MIX = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
streams AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x FROM docs),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn
  FROM docs GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][turn + 1] AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS most FROM sources),
shares AS (
  SELECT *, (SELECT sum(source_size) FROM weighed) - coalesce(sum(most) OVER (ORDER BY most / weight
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS words,
    sum(weight) OVER (ORDER BY most / weight RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed),
level AS (
  SELECT words, share FROM shares WHERE weight * words / share < most ORDER BY most / weight LIMIT 1),
targets AS (
  SELECT source, source_size, turn, coalesce(least(weight * (SELECT words FROM level) / (SELECT share FROM level), most), 0.0) AS target
  FROM weighed),
taken AS (
  SELECT doc_id, size, source_size, target, turn, x,
    list_sum(list_transform([0, 1, 2], lambda k: greatest(least(CAST(floor(target) AS BIGINT) - (k * source_size + x), size), 0))) AS taken
  FROM streams JOIN targets ON streams.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN least(1.0, CASE turn
    WHEN 0 THEN 0.0 + (sqrt(greatest(2.25 + -2.0 * (x / target), 0.0)) - 1.5) / -1.0
    WHEN 1 THEN x / target
    ELSE (sqrt(greatest(0.25 + 2.0 * (x / target), 0.0)) - 0.5) / 1.0 END) END AS position
FROM taken"""


def _clusters(rounds: int = 3) -> str:
    """All distances in every round; the mean's floor is exact for negative sums."""
    near = """
near{i} AS (
  SELECT r, min(16 * list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) + c.c) AS m
  FROM kept k CROSS JOIN centroids{i} c GROUP BY r)"""
    move = """,
sums{i} AS (
  SELECT c, d, sum(x) AS s, count(*) AS n FROM (
    SELECT m % 16 AS c, unnest(v) AS x, unnest(range(64)) AS d FROM near{i} JOIN kept USING (r)) GROUP BY c, d),
means{i} AS (SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM sums{i} GROUP BY c),
centroids{j} AS (SELECT c, coalesce(m.v, o.v) AS v FROM centroids{i} o LEFT JOIN means{i} m USING (c)),"""
    steps = "".join(near.format(i=i) + move.format(i=i, j=i + 1) for i in range(rounds)) + near.format(i=rounds)
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(embedding) = 64),
centroids0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c, v FROM kept
  WHERE vec_id IS NOT NULL QUALIFY c < 16),{steps},
placed AS (SELECT vec_id, m % 16 AS c, CAST(m // 16 AS BIGINT) AS distance FROM near{rounds} JOIN kept USING (r))
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
FROM placed JOIN centroids{rounds} USING (c)"""


TWINS = {
    "op2_substring_dedup": SUBSTRING,
    "op3_decontamination": CONTAMINATION,
    "op4_chat_format": CHAT,
    "op5_embedding_near_dedup": VECTORS,
    "op9_license_scan": LICENSES,
    "op11_centroid_clusters": _clusters(),
    "op12_source_mix": MIX,
    "op13_periodic_runs": PERIODIC,
}
