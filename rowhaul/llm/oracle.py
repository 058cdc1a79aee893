"""DuckDB SQL for the results of operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPEATED_WINDOWS = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT r, doc_id, p, array_to_string(ws[p:p + 12], ' ') AS w
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM docs WHERE doc_id IS NOT NULL)),
least AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
  SELECT DISTINCT r, q FROM (
    SELECT r, unnest(range(p, p + 13)) AS q FROM windows JOIN least USING (w) WHERE first < doc_id)),
places AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM docs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY q) AS text FROM places ANTI JOIN gone USING (r, q) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""

SHINGLE_JOIN = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT r, doc_id, array_to_string(ws[p:p + 3], ' ') AS s
  FROM (SELECT r, doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS p FROM docs WHERE len(ws) > 0)),
sizes AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM common c JOIN sizes x ON c.a = x.r JOIN sizes y ON c.b = y.r
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT doc_id, coalesce(sizes.n, 0) AS n_shingles, least(docs.doc_id, (SELECT min(b) FROM reach WHERE reach.a = docs.doc_id)) AS component_id
FROM (SELECT r, doc_id FROM docs) docs LEFT JOIN (SELECT r, n FROM sizes) sizes USING (r)
"""


def _checksums() -> list[int]:
    """The table of the reflected polynomial 0xEDB88320, for each byte."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        out.append(byte)
    return out


SPELLING_VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (SELECT *, hex(encode(doc_id || ':' || run)) AS hx FROM runs),
sums AS (
  SELECT doc_id, run, n, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(hx), 2), lambda p: CAST('0x' || hx[p:p + 1] AS BIGINT))),
    lambda c, b: xor(c >> 8, CAST({_checksums()} AS BIGINT[])[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM bytes),
results AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM sums),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
best AS (SELECT word, n, count(*) AS n_near, max(m) AS top FROM near GROUP BY word, n),
forms AS (SELECT best.word, min(other) AS form, any_value(top) AS form_n FROM best JOIN near ON near.word = best.word AND m = top WHERE top >= 10 * best.n GROUP BY best.word),
chains AS (
  SELECT word, form AS last, 1 AS depth FROM forms
  UNION ALL SELECT chains.word, forms.form, depth + 1 FROM chains JOIN forms ON chains.last = forms.word),
ends AS (SELECT word, arg_max(last, depth) AS root FROM chains GROUP BY word)
SELECT words.word, form, coalesce(root, words.word) AS root, words.n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN forms USING (word) LEFT JOIN ends USING (word) LEFT JOIN (SELECT word, n_near FROM best) near_counts USING (word)
"""


def _clusters(rounds: int = 3) -> str:
    assign = """near{k} AS (
  SELECT r, arg_min(c, (far, c)) AS c, min(far) AS far FROM (
    SELECT r, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far FROM kept, means{k}) GROUP BY r)"""
    move = """means{n} AS MATERIALIZED (
  SELECT c, coalesce(moved.m, means{k}.m) AS m FROM means{k} LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS m FROM (
      SELECT c, p, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS p FROM kept JOIN near{k} USING (r)) GROUP BY c, p) GROUP BY c) moved USING (c))"""
    steps = [step.format(k=k, n=k + 1) for k in range(rounds) for step in (assign, move)] + [assign.format(k=rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
means0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v AS m FROM kept ORDER BY c LIMIT 16),
{", ".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance, CAST(sum(far) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(far) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN means{rounds} USING (c)
"""


CLUSTERS = _clusters()

FREQUENT_LINES = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM docs),
keyed AS (SELECT *, {_LOWERED.format(f"trim(line, {_SPACES})")} AS key FROM lines),
frequent AS (SELECT key, true AS gone FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (key) GROUP BY r
"""
