"""SQL (DuckDB) counterparts of the registered queries, written on their own."""

from __future__ import annotations

from retentia.llm.common import draw_sql
from retentia.llm.fingerprints import MatchSettings
from retentia.llm.queries import LICENSES, SHARDS, SLOTS

ORACLE: dict[str, str] = {}

_HEX = "('0x' || substr(md5({}), 1, 15))::BIGINT"

ORACLE["op1_sharding"] = f"""
WITH RECURSIVE
shards AS MATERIALIZED (
  SELECT CAST(i AS BIGINT) AS i, 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range({len(SHARDS)}) t(i)),
prefs AS MATERIALIZED (
  SELECT i, {_HEX.format("name || ':offset'")} % {SLOTS} AS o, {_HEX.format("name || ':stride'")} % {SLOTS - 1} + 1 AS s FROM shards),
lists AS MATERIALIZED (SELECT list(o ORDER BY i) AS os, list(s ORDER BY i) AS ss FROM prefs),
fill(turn, owner, slot) AS (
  SELECT CAST(0 AS BIGINT), list_transform(range({SLOTS}), lambda x: CAST(-1 AS BIGINT)), CAST(-1 AS BIGINT)
  UNION ALL
  SELECT turn + 1, list_concat(list_concat(owner[:free], [turn % {len(SHARDS)}]), owner[free + 2:]), free
  FROM (
    SELECT turn, owner, list_filter(
      list_transform(range({SLOTS}), lambda j: (os[turn % {len(SHARDS)} + 1] + j * ss[turn % {len(SHARDS)} + 1]) % {SLOTS}),
      lambda p: owner[p + 1] = -1)[1] AS free
    FROM fill, lists WHERE turn < {SLOTS})),
slots AS (SELECT slot, (turn - 1) % {len(SHARDS)} AS i FROM fill WHERE slot >= 0),
placed AS (SELECT *, {draw_sql(0, "shard", "doc_id")} % {SLOTS} AS place FROM documents)
SELECT doc_id, CAST(place AS INTEGER) AS slot, name AS shard
FROM placed JOIN slots ON slot = place JOIN shards USING (i)
"""

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE["op2_mixing"] = f"""
WITH d AS (
  SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size, {draw_sql(0, "mix", "doc_id")} AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST([1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight, 3 * source_size AS most FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER o, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY CAST(most AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CAST(most AS DOUBLE) / weight < level AS capped FROM l),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(most AS DOUBLE)
         ELSE weight * max(CASE WHEN NOT capped THEN level END) OVER () END AS target FROM c),
r AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ({draw_sql(0, "offset", "CASE WHEN d.source IS NULL THEN 'n' ELSE 's' || d.source END")} % 1024)::DOUBLE / 1024 AS u,
    row_number() OVER (PARTITION BY d.source ORDER BY
      length(bin(size)) * 128 + (size >> greatest(length(bin(size)) - 7, 0)), h % 256, size, h, doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * least(floor(u + k * rate) - floor(u + (k - 1) * rate), 3) AS BIGINT) AS taken
FROM r
"""

ORACLE["op10_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(len(a.q)), lambda i: a.q[i + 1] * b.q[i + 1])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

ORACLE["op4_minhash_near_dedup"] = r"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(
        range(greatest(len(w) - 4, least(len(w), 1))), lambda i: md5(array_to_string(w[i + 1 : i + 5], ' ')))) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, reached) AS (SELECT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id,
  coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT id, min(reached) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_TEMPLATE_ROWS = ", ".join("({}, '{}', {}, '{}')".format(i, t.label, str(t.phrase).lower(), t.text.replace("'", "''")) for i, t in enumerate(LICENSES))

ORACLE["op3_license_scan"] = f"""
WITH t AS (
  SELECT i, label, phrase, regexp_extract_all({_LOWER.format("body")}, {_TERM}) AS w FROM (VALUES {_TEMPLATE_ROWS}) x(i, label, phrase, body)),
tr AS (
  SELECT i, label, phrase, len(w) - 2 AS runs, unnest(range(len(w) - 2)) AS at_,
    unnest(list_transform(range(len(w) - 2), lambda j: array_to_string(w[j + 1 : j + 3], ' '))) AS run FROM t),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, {_TERM}) AS w FROM documents),
r AS (
  SELECT doc_id, unnest(range(greatest(len(w) - 2, 0))) AS place,
    unnest(list_transform(range(greatest(len(w) - 2, 0)), lambda j: array_to_string(w[j + 1 : j + 3], ' '))) AS run FROM d),
g AS (
  SELECT doc_id, i, label, phrase, runs, place - at_ AS diagonal, list(DISTINCT at_) AS covered, min(place) AS low, max(place) AS high
  FROM r JOIN tr USING (run) GROUP BY ALL),
m AS (SELECT *, CASE WHEN phrase OR lag(diagonal) OVER o IS NULL OR diagonal - lag(diagonal) OVER o > 4 THEN 1 ELSE 0 END AS fresh
      FROM g WINDOW o AS (PARTITION BY doc_id, i ORDER BY diagonal)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, i ORDER BY diagonal) AS span FROM m),
s AS (
  SELECT doc_id, i, label, phrase, runs, span, len(list_distinct(flatten(list(covered)))) AS covered, min(diagonal) AS start, max(high) - min(low) + 3 AS length
  FROM n GROUP BY ALL),
v AS (
  SELECT *, covered / runs AS share, phrase AND covered = runs AS whole,
    (phrase AND covered = runs) OR (NOT phrase AND covered / runs >= 0.6 AND length <= 1.5 * (runs + 2)) AS found FROM s),
a AS (
  SELECT doc_id, count(*) FILTER (whole) AS n_base, min(start) FILTER (whole) AS first_word, max(start) FILTER (whole) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found) AS labels, max(share) FILTER (found) AS score FROM v GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""

_M = MatchSettings()
_SUBSETS = range(_M.subsets)


def _print_sql(kind: int) -> str:
    parts = ", ".join(f"coalesce(lower(to_hex(h{i})), '-')" for i in _SUBSETS)
    some = ", ".join(f"h{i}" for i in _SUBSETS)
    return f"SELECT doc_id, CASE WHEN coalesce({some}) IS NULL THEN 'text:' || whole ELSE concat_ws('.', {parts}) END AS f FROM s WHERE kind = {kind}"


def _likeness_sql(a: str, b: str) -> str:
    zipped = f"list_zip(string_split({a}, '.'), string_split({b}, '.'))"
    used = f"len(list_filter({zipped}, lambda p: p[1] <> '-' OR p[2] <> '-'))"
    same = f"len(list_filter({zipped}, lambda p: p[1] <> '-' AND p[1] = p[2]))"
    return f"CASE WHEN {a} = {b} THEN 1.0 WHEN {a} LIKE 'text:%' OR {b} LIKE 'text:%' THEN 0.0 ELSE ({same}) / ({used}) END::DOUBLE"


ORACLE["op7_fingerprints"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
e AS (
  SELECT doc_id, text, coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id,
    substr(text, 1, length(text) - length(text) // 3) || substr(coalesce(lead(text) OVER o, first_value(text) OVER o), 1, length(text) // 3) AS edited
  FROM d WINDOW o AS (ORDER BY doc_id DESC)),
x AS (SELECT doc_id, 0 AS kind, text FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
w AS (SELECT doc_id, kind, unnest(list_distinct(list_transform(regexp_extract_all(text, r'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: lower(t)))) AS term FROM x),
l AS MATERIALIZED (
  SELECT term, ('0x' || substr(md5('{_M.seed}:' || term), 1, 15))::BIGINT AS code FROM (SELECT term, count(*) AS n FROM w WHERE kind = 0 GROUP BY term)
  WHERE n >= 2 AND n >= {_M.rare} * (SELECT count(*) FROM d) AND n <= {_M.common} * (SELECT count(*) FROM d)),
h AS (
  SELECT doc_id, kind, {", ".join(f"bit_xor(code) FILTER (('0x' || substr(md5('{_M.seed}:{i}:' || term), 1, 15))::BIGINT % {2 ** (i // _M.each + 1)} = 0) AS h{i}" for i in _SUBSETS)}
  FROM w JOIN l USING (term) GROUP BY doc_id, kind),
s AS (SELECT x.doc_id, x.kind, md5(x.text) AS whole, h.* EXCLUDE (doc_id, kind) FROM x LEFT JOIN h ON h.doc_id = x.doc_id AND h.kind = x.kind),
f0 AS ({_print_sql(0)}),
f1 AS ({_print_sql(1)})
SELECT e.doc_id, CAST(length(e.text) AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
  {_likeness_sql("a.f", "b.f")} AS near_edited, {_likeness_sql("a.f", "c.f")} AS near_next
FROM e JOIN f0 a ON a.doc_id = e.doc_id JOIN f1 b ON b.doc_id = e.doc_id JOIN f0 c ON c.doc_id = e.next_id
""".replace("r'[", "'[")

# From the definition: of equal stretches of lines with two that are not blank, blanks at the ends of lines aside, all but the first go.
ORACLE["op6_line_dedup"] = """
WITH d AS (
  SELECT DISTINCT doc_id, md5(coalesce(text, '')) AS t, string_split(coalesce(text, ''), chr(10)) AS l,
    list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ')) AS bare FROM documents),
e AS (SELECT doc_id, t, len(l) AS n, unnest(range(len(l))) AS p, unnest(l) AS line, unnest(bare) AS bare FROM d),
f AS (
  SELECT doc_id, t, n, p, lag(p) OVER w AS prior, lead(p) OVER w AS q, lead(p, 2) OVER w AS after
  FROM e WHERE bare <> '' WINDOW w AS (PARTITION BY doc_id, t ORDER BY p)),
s AS (
  SELECT doc_id, t, a, b FROM f, unnest(range(coalesce(prior, -1) + 1, p + 1)) x(a), unnest(range(q, coalesce(after, n))) y(b) WHERE q IS NOT NULL),
r AS (SELECT s.*, array_to_string(bare[a + 1 : b + 1], chr(10)) AS body FROM s JOIN d USING (doc_id, t)),
o AS (SELECT doc_id, t, a, b, row_number() OVER (PARTITION BY body ORDER BY doc_id, t, a) AS nth FROM r),
g AS (SELECT DISTINCT doc_id, t, unnest(range(a, b + 1)) AS p FROM o WHERE nth > 1),
k AS (
  SELECT e.doc_id, e.t, count(g.p) AS gone, string_agg(CASE WHEN g.p IS NULL THEN e.line END, chr(10) ORDER BY e.p) AS body
  FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.t = e.t AND g.p = e.p GROUP BY e.doc_id, e.t)
SELECT x.doc_id, CAST(CASE WHEN x.text IS NULL THEN 0 ELSE len(d.l) END AS BIGINT) AS n_lines, CAST(gone AS BIGINT) AS n_removed,
  sha256(coalesce(k.body, '')) AS kept_sha256
FROM documents x JOIN d ON d.doc_id = x.doc_id AND d.t = md5(coalesce(x.text, '')) JOIN k ON k.doc_id = d.doc_id AND k.t = d.t
"""

ORACLE["op9_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 800)) AS s FROM (SELECT doc_id, x, unnest(range(greatest(len(x) // 2 - 399, 0))) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM w) WHERE n > 1),
e AS (SELECT doc_id, i, max(i + 400) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
g AS (SELECT doc_id, i, sum(CASE WHEN reach IS NULL OR i > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM e),
s AS (SELECT doc_id, span, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY ALL),
p AS (SELECT doc_id, count(*) AS n, sum(b - a) AS gone, list({'a': a, 'b': b} ORDER BY a) AS spans FROM s GROUP BY doc_id),
k AS (
  SELECT d.doc_id, x, coalesce(n, 0) AS n, coalesce(gone, 0) AS gone,
    CASE WHEN n IS NULL THEN x ELSE array_to_string(list_transform(range(n + 1), lambda j:
      substr(x, 2 * (CASE WHEN j = 0 THEN 0 ELSE spans[j].b END) + 1,
        2 * ((CASE WHEN j = n THEN len(x) // 2 ELSE spans[j + 1].a END) - (CASE WHEN j = 0 THEN 0 ELSE spans[j].b END)))), '') END AS kept
  FROM d LEFT JOIN p ON p.doc_id = d.doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(gone AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256,
  CAST(len(x) // 2 - gone AS BIGINT) AS n_kept, try(decode(unhex(kept))) AS kept FROM k
"""

ORACLE["op11_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(len(w) - 49)) AS i, unnest(list_transform(range(len(w) - 49), lambda i: md5(array_to_string(w[i + 1 : i + 50], ' ')))) AS s
  FROM d WHERE len(w) >= 50),
f AS (SELECT s, min(doc_id) AS owner FROM x GROUP BY s),
r AS (SELECT x.doc_id, i FROM x JOIN f ON f.s = x.s AND owner < x.doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM r),
t AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS word FROM d),
k AS (
  SELECT t.doc_id, count(g.p) AS gone, coalesce(string_agg(CASE WHEN g.p IS NULL THEN word END, ' ' ORDER BY t.p), '') AS kept
  FROM t LEFT JOIN g ON g.doc_id = t.doc_id AND g.p = t.p GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
  CAST(len(w) - coalesce(gone, 0) AS BIGINT) AS n_kept, CASE WHEN coalesce(gone, 0) = 0 THEN coalesce(x.text, '') ELSE kept END AS kept
FROM d JOIN documents x ON x.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""

_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

ORACLE["op12_importance_resampling"] = f"""
WITH RECURSIVE
steps(i, n, c) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) t(i) UNION ALL SELECT i, n + 1, {_CRC_STEP} FROM steps WHERE n < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM steps WHERE n = 8),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, {_TERM}) AS w FROM documents),
x AS (SELECT doc_id, unnest(w) AS word FROM d),
y AS (SELECT unnest(regexp_extract_all({_LOWER.format("text")}, {_TERM})) AS word FROM benchmark),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM x UNION SELECT word FROM y)),
b AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, o: xor(c >> 8, t[(xor(c, o) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM v, crc),
s AS (SELECT bucket, count(*) AS n FROM x JOIN b USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM y JOIN b USING (word) GROUP BY bucket),
g AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM x) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM y) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
m AS (SELECT doc_id, count(*) AS n, sum(gain) AS weight FROM x JOIN b USING (word) JOIN g USING (bucket) GROUP BY doc_id),
o AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN m ON m.doc_id = d.doc_id),
r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM o WHERE n_features >= 20)
SELECT o.*, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM o LEFT JOIN r ON r.doc_id = o.doc_id
"""


def _clusters_sql(clusters: int = 8, rounds: int = 10) -> str:
    nearest = """SELECT v.vec_id, v.x, arg_min(c.c, [list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.c]) AS cluster,
      CAST(min(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS BIGINT) AS distance
    FROM v, c{0} c GROUP BY v.id, v.vec_id, v.x"""
    steps = [f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT {clusters}))"""]
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED ({nearest.format(i)}),
m{i} AS (SELECT cluster, at_, CAST(floor(sum(y)::DOUBLE / count(*)) AS BIGINT) AS y
  FROM (SELECT cluster, unnest(range(64)) AS at_, unnest(x) AS y FROM a{i}) GROUP BY cluster, at_),
n{i} AS (SELECT cluster, list(y ORDER BY at_) AS x FROM m{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.x, o.x) AS x FROM c{i} o LEFT JOIN n{i} n ON n.cluster = c)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
{", ".join(steps)},
a AS MATERIALIZED ({nearest.format(rounds)})
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a JOIN c{rounds} c ON c.c = cluster
"""


ORACLE["op13_centroid_clustering"] = _clusters_sql()
