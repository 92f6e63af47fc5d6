"""The registered queries as SQL for an independent engine, over the same tables.

The SQL states each result from its definition (words unnested, vectors as lists); it shares only fixed values
such as the stop words with the Spark code.
"""

from __future__ import annotations

from topicstream.functions.text import DROP_IF_CONTAINS, LINKS_AND_MENTIONS, NOISE, SPACE, STOP_WORDS
from topicstream.functions.text import WORD as WORD_PATTERN
from topicstream.plans.queries import PHRASES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _stem(w: str) -> str:
    return (
        f"CASE WHEN {w} LIKE '%ies' THEN CASE WHEN {w} LIKE '%eies' OR {w} LIKE '%aies' THEN {w} "
        f"ELSE left({w}, length({w}) - 3) || 'y' END "
        f"WHEN {w} LIKE '%es' THEN CASE WHEN {w} LIKE '%aes' OR {w} LIKE '%ees' OR {w} LIKE '%oes' THEN {w} "
        f"ELSE left({w}, length({w}) - 1) END "
        f"WHEN {w} LIKE '%s' AND NOT ({w} LIKE '%us' OR {w} LIKE '%ss' OR {w} = 's') THEN left({w}, length({w}) - 1) "
        f"ELSE {w} END"
    )


def _sanitize(w: str) -> str:
    return f"regexp_replace({w}, {_text(NOISE)}, '', 'g')"


def _kept(w: str) -> str:
    return f"{w} <> '' AND {w} <> 'rt' AND " + " AND ".join(f"NOT contains({w}, {_text(p)})" for p in DROP_IF_CONTAINS)


STOP = _list(STOP_WORDS)
SPLIT = f"regexp_split_to_array(lower(text), {_text(SPACE)})"
HASH = (
    "(list_reduce(list_prepend(0::BIGINT, list_transform(string_split(word, ''), "
    "lambda c: CASE WHEN c = '' THEN 0 ELSE unicode(c) END::BIGINT)), lambda h, c: (h * 31 + c) & 4294967295))"
)


def _bucket(dims: int) -> str:
    signed = f"({HASH} - CASE WHEN {HASH} > 2147483647 THEN 4294967296 ELSE 0 END)"
    return f"((({signed} % {dims}) + {dims}) % {dims})::INTEGER"


ALL_DOCS = "docs AS (SELECT doc_id AS id, text, lang, source, n_chars FROM documents)"
POSTS = (
    "links AS (SELECT doc_id AS id, source || '/' || lang AS url FROM documents WHERE lang <> 'en' "
    "UNION ALL SELECT doc_id, 'front/' || (doc_id % 3) FROM documents WHERE doc_id % 2 = 0), "
    "posts AS (SELECT doc_id AS id, text, regexp_extract(source, '(\\d+)', 1)::BIGINT AS source "
    "FROM documents)"
)
TOKENS = f"""{POSTS},
raw_words AS (SELECT id, unnest({SPLIT}) AS w FROM posts),
stemmed AS (SELECT id, {_stem("w")} AS w FROM raw_words),
sanitized AS (SELECT id, {_sanitize("w")} AS word FROM stemmed),
tokens AS (SELECT id, word FROM sanitized WHERE {_kept("word")} AND word NOT IN {STOP}),
vocabulary AS (SELECT word, {_bucket(100)} AS bucket FROM (SELECT DISTINCT word FROM tokens))"""
WEIGHTS = f"""{TOKENS},
tf AS (SELECT id, bucket, count(*) AS n FROM tokens JOIN vocabulary USING (word) GROUP BY id, bucket),
idf AS (SELECT bucket, ln(((SELECT count(*) FROM posts) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY bucket),
weights AS (SELECT id, bucket, n * idf AS w FROM tf JOIN idf USING (bucket))"""
VECTORS = f"""{WEIGHTS},
cells AS (SELECT p.id, p.source, b.range AS b, coalesce(w.w, 0.0) AS x FROM posts p CROSS JOIN range(100) b
  LEFT JOIN weights w ON w.id = p.id AND w.bucket = b.range),
vectors AS (SELECT id, source, list(x ORDER BY b) AS v, sum(x) AS s FROM cells GROUP BY id, source),
centers AS (SELECT cluster_id, list(x ORDER BY b) AS c, max(n)::DOUBLE AS weight FROM
  (SELECT source AS cluster_id, b, avg(x) AS x, count(*) AS n FROM cells GROUP BY source, b) GROUP BY cluster_id)"""
ASSIGNED = f"""{VECTORS},
neighbors AS (SELECT cluster_id, neighbor_id, c AS neighbor FROM
  (SELECT a.cluster_id, b.cluster_id AS neighbor_id, b.c,
     row_number() OVER (PARTITION BY a.cluster_id ORDER BY list_distance(a.c, b.c), b.cluster_id) AS r
   FROM centers a JOIN centers b ON a.cluster_id <> b.cluster_id) WHERE r = 1),
nearest AS (SELECT id, cluster_id, v, s, d FROM
  (SELECT id, cluster_id, v, s, list_distance(v, c) AS d,
     row_number() OVER (PARTITION BY id ORDER BY list_distance(v, c), cluster_id) AS r
   FROM vectors, centers WHERE s > 0) WHERE r = 1),
assigned AS (SELECT p.id % 4 AS batch_id, p.id, p.text, h.cluster_id, n.neighbor_id, h.s AS vec_sum, h.d * h.d / h.s AS own,
   list_distance(h.v, n.neighbor) * list_distance(h.v, n.neighbor) / h.s AS other
  FROM posts p LEFT JOIN nearest h USING (id) LEFT JOIN neighbors n USING (cluster_id))"""


def _report(keys: str, source: str = "assigned", name: str = "report") -> str:
    return f"""{name}_reps AS (SELECT {keys}, id AS rep_id, text AS rep_text FROM
  (SELECT {keys}, id, text, row_number() OVER (PARTITION BY {keys} ORDER BY round(own, 9), id) AS r FROM {source}
   WHERE cluster_id IS NOT NULL) WHERE r = 1),
{name}_scores AS (SELECT {keys}, count(*) AS count, avg(own) AS intra, avg(other) AS inter FROM {source}
  WHERE cluster_id IS NOT NULL GROUP BY {keys}),
{name}_raw AS (SELECT *, CASE WHEN greatest(intra, inter) = 0 THEN 0.0 ELSE (inter - intra) / greatest(intra, inter) END
  AS silhouette FROM {name}_scores),
{name}_best AS (SELECT {keys}, url FROM (SELECT {keys}, url, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, url DESC) AS r
  FROM {source} JOIN links USING (id) WHERE cluster_id IS NOT NULL GROUP BY {keys}, url) WHERE r = 1),
{name} AS (SELECT {keys}, count, round(silhouette, 2) + 0.0 AS silhouette, round(intra, 2) + 0.0 AS intra,
  round(inter, 2) + 0.0 AS inter, count >= 8 AND silhouette >= 0.4 AND silhouette <= 0.95 AS interesting,
  rep_id, rep_text, coalesce(url, 'none') AS best_url FROM {name}_raw JOIN {name}_reps USING ({keys}) LEFT JOIN {name}_best USING ({keys}))"""


REPORT = f"{ASSIGNED},\n{_report('batch_id, cluster_id')}"
TOTALS = f"{ASSIGNED},\n{_report('cluster_id')}"
HISTORY = """report AS (SELECT batch_id, cluster_id, count, round(mean / top, 2) AS silhouette, rep_id, 'none' AS best_url,
  count >= 8 AND mean / top >= 0.4 AND mean / top <= 0.95 AS interesting FROM (
  SELECT date_diff('day', DATE '2024-01-01', ts::DATE) // 7 * 3 + 2 AS batch_id, user_id * 10 + ascii(event_type) % 10 AS cluster_id,
    count(*) AS count, avg(value) AS mean, max(value) AS top, min(event_id) AS rep_id FROM events GROUP BY 1, 2)),
batches AS (SELECT batch_id, dense_rank() OVER (ORDER BY batch_id) - 1 AS batch_index FROM (SELECT DISTINCT batch_id FROM report)),
keep AS (SELECT DISTINCT cluster_id FROM report WHERE interesting),
grid AS (SELECT k.cluster_id, b.batch_index, coalesce(r.count, 0) AS count, r.silhouette, r.rep_id, r.best_url
  FROM keep k CROSS JOIN batches b LEFT JOIN report r ON r.cluster_id = k.cluster_id AND r.batch_id = b.batch_id)"""
COLLISIONS = f"""{TOKENS},
merged AS (SELECT bucket, word, count(*) OVER (PARTITION BY bucket) AS n_words FROM vocabulary)"""
BATCH_COLLISIONS = f"""{TOKENS},
batch_words AS (SELECT DISTINCT id % 4 AS batch_id, bucket, word FROM tokens JOIN vocabulary USING (word))"""
EMBEDDINGS = """e AS (SELECT vec_id AS id, label::BIGINT AS cluster_id, embedding::DOUBLE[] AS v FROM embeddings),
cells AS (SELECT id, cluster_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
centers AS (SELECT cluster_id, list(x ORDER BY i) AS c, max(n)::DOUBLE AS weight FROM
  (SELECT cluster_id, i, avg(x) AS x, count(*) AS n FROM cells GROUP BY cluster_id, i) GROUP BY cluster_id)"""


def _nearest(centers: str) -> str:
    return f"""nearest AS (SELECT id, v, cluster_id, d FROM (SELECT e.id, e.v, k.cluster_id, list_distance(e.v, k.c) AS d,
  row_number() OVER (PARTITION BY e.id ORDER BY list_distance(e.v, k.c), k.cluster_id) AS r FROM e, {centers} k) WHERE r = 1)"""


TRAINED = f"""{EMBEDDINGS},
{_nearest("centers")},
hit_cells AS (SELECT cluster_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM nearest),
sums AS (SELECT cluster_id, i, sum(x) AS x, count(*) AS n FROM hit_cells GROUP BY cluster_id, i),
old AS (SELECT cluster_id, unnest(c) AS c, generate_subscripts(c, 1) AS i, weight FROM centers),
trained AS (SELECT o.cluster_id, 0.7 * weight + coalesce(n, 0) AS weight,
  CASE WHEN n IS NULL THEN c ELSE (0.7 * weight * c + x) / (0.7 * weight + n) END AS c
  FROM old o LEFT JOIN sums s ON s.cluster_id = o.cluster_id AND s.i = o.i)"""
NORMAL = f"""norm AS (SELECT id, array_to_string(list_transform(list_filter(
  regexp_split_to_array(regexp_replace(text, {_text(LINKS_AND_MENTIONS)}, '', 'g'), '\\s+'), lambda w: w <> ''),
  lambda w: {_stem("lower(w)")}), ' ') AS t FROM docs)"""
GROUPS = f"""{ALL_DOCS}, {NORMAL},
groups AS (SELECT id, min(id) OVER (PARTITION BY t) AS rep_id, count(*) OVER (PARTITION BY t) AS copies FROM norm)"""
WORDS = f"""{POSTS},
all_words AS (SELECT id, source, unnest(regexp_extract_all(lower(text), {_text(WORD_PATTERN)})) AS word FROM posts),
counts AS (SELECT id, source, word, count(*) AS n FROM all_words WHERE word NOT IN {STOP} GROUP BY ALL)"""
TFIDF = f"""{WORDS},
m AS (SELECT count(*) AS m FROM posts),
df AS (SELECT word, count(*) AS df, ln((1 + any_value(m)) / (1 + count(*))) + 1 AS idf FROM counts, m GROUP BY word),
raw_weights AS (SELECT id, source, word, n * idf AS w FROM counts JOIN df USING (word), m WHERE df >= 2 AND df <= 0.5 * m),
tfidf AS (SELECT id, source, word, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw_weights)"""
EVENT_POSTS = """sent AS (SELECT event_id AS id, 'u' || user_id AS mention, 'u' || ((user_id + 1) % 150) AS author,
  (user_id + 1) % 150 AS author_id, floor(value)::BIGINT AS followers, event_type || ' ' || props AS text,
  event_type || ',k' || json_extract_string(props, '$.k') AS hashtags, (epoch_us(ts) // 1000)::VARCHAR AS timestamp_ms,
  event_type FROM events), kept AS (SELECT * FROM sent WHERE event_type <> 'error')"""
HOSTS = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"
TERMS = f"""SELECT DISTINCT trim(t) AS term FROM (SELECT replace(lower({HOSTS}), '.', ' ') AS t FROM pages
  UNION ALL SELECT n_name FROM nation UNION ALL SELECT replace(s_name, '#', '_') FROM supplier)"""


def _words_of(keep: str, expression: str) -> str:
    return (
        f"WITH {ALL_DOCS} SELECT id, array_to_string(list_filter(list_transform({SPLIT}, lambda w: {expression}), "
        f"lambda w: {keep}), ' ') AS tokens FROM docs"
    )


ADMITTED = f"""{VECTORS.replace("posts AS (", "posts AS MATERIALIZED (", 1)},
ordered AS MATERIALIZED (SELECT v, s, row_number() OVER (ORDER BY id) AS r FROM vectors WHERE s > 0),
pass AS (SELECT 0::BIGINT AS r, []::DOUBLE[][] AS admitted
  UNION ALL SELECT o.r, CASE WHEN len(list_filter(p.admitted, lambda a: list_distance(o.v, a) * list_distance(o.v, a) / o.s < 2.2)) = 0
    THEN list_append(p.admitted, o.v) ELSE p.admitted END FROM pass p JOIN ordered o ON o.r = p.r + 1),
final AS (SELECT admitted FROM pass ORDER BY r DESC LIMIT 1),
numbered AS (SELECT unnest(admitted) AS c, generate_subscripts(admitted, 1) AS pos, len(admitted) AS n FROM final)"""
MERGED = """e AS MATERIALIZED (SELECT vec_id AS id, label + 1.0 AS weight, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS MATERIALIZED (SELECT i, j, wi, wj, row_number() OVER (ORDER BY i, j) AS r FROM (SELECT a.id AS i, b.id AS j,
  a.weight AS wi, b.weight AS wj, list_distance(a.v, b.v) AS d FROM e a JOIN e b ON a.id < b.id) WHERE d * d < 1.2),
pass AS (SELECT 0::BIGINT AS r, []::BIGINT[] AS gone, []::STRUCT(k BIGINT, w DOUBLE)[] AS gains
  UNION ALL SELECT p.r,
    CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gone
      WHEN wi > wj THEN list_append(gone, j) ELSE list_append(gone, i) END,
    CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gains
      WHEN wi > wj THEN list_append(gains, {'k': i, 'w': wj}) ELSE list_append(gains, {'k': j, 'w': wi}) END
  FROM pass s JOIN pairs p ON p.r = s.r + 1),
final AS (SELECT * FROM pass ORDER BY r DESC LIMIT 1),
gained AS (SELECT g.k AS id, sum(g.w) AS w FROM (SELECT unnest(gains) AS g FROM final) GROUP BY 1)"""
DBSCAN = f"""{TFIDF.replace("tfidf AS (", "tfidf AS MATERIALIZED (", 1)},
points AS (SELECT DISTINCT id FROM tfidf),
near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM tfidf a JOIN tfidf b ON a.word = b.word GROUP BY a.id, b.id
  HAVING sum(a.w * b.w) >= 0.955 - 1e-9),
core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id AS a, id AS b FROM core UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
labels_of AS (SELECT b AS id, min(a) AS label FROM reach GROUP BY b),
border AS (SELECT n.b AS id, min(l.label) AS label FROM near n JOIN labels_of l ON l.id = n.a GROUP BY n.b)"""

# The products of all pairs of posts stand in for their word vectors: distances to a mean and the strongest directions follow from them.
KERNEL = f"""{TFIDF.replace("tfidf AS (", "tfidf AS MATERIALIZED (", 1)},
kernel AS MATERIALIZED (SELECT a.id AS i, b.id AS j, sum(a.w * b.w) AS p FROM tfidf a JOIN tfidf b ON a.word = b.word GROUP BY a.id, b.id),
points AS MATERIALIZED (SELECT DISTINCT id FROM tfidf)"""


def _kmeans(k: int, name: str, rounds: int = 10) -> str:
    """Members (c, j) of each center round by round; a center without posts keeps its members. Ends in {name} (id, label)."""
    parts = [f"{name}_m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY md5(id::VARCHAR), id) - 1 AS c, id AS j FROM points QUALIFY c < {k})"]
    for r in range(rounds + 1):
        parts.append(f"""{name}_n{r} AS MATERIALIZED (SELECT a.c, sum(coalesce(p, 0)) / any_value(n * n) AS norm, any_value(n) AS n FROM {name}_m{r} a
  JOIN {name}_m{r} b USING (c) JOIN (SELECT c, count(*) AS n FROM {name}_m{r} GROUP BY c) z USING (c)
  LEFT JOIN kernel k ON k.i = a.j AND k.j = b.j GROUP BY a.c),
{name}_d{r} AS MATERIALIZED (SELECT i, c, sum(p) AS s FROM kernel JOIN {name}_m{r} USING (j) GROUP BY i, c),
{name}_a{r} AS MATERIALIZED (SELECT id, c AS label FROM (SELECT q.id, q.c, row_number() OVER (PARTITION BY q.id
  ORDER BY round(norm - 2 * coalesce(s, 0) / n, 9), q.c) AS place FROM (SELECT * FROM points CROSS JOIN {name}_n{r}) q
  LEFT JOIN {name}_d{r} d ON d.c = q.c AND d.i = q.id) WHERE place = 1)""")
        if r < rounds:
            parts.append(f"""{name}_m{r + 1} AS MATERIALIZED (SELECT label AS c, id AS j FROM {name}_a{r}
  UNION ALL SELECT c, j FROM {name}_m{r} WHERE c NOT IN (SELECT label FROM {name}_a{r}))""")
    return ",\n".join(parts) + f",\n{name} AS (SELECT * FROM {name}_a{rounds})"


def _silhouette(k: int) -> str:
    """Mean silhouette of the labels by squared distances between unit vectors."""
    name = f"k{k}"
    return f"""{_kmeans(k, name)},
{name}_size AS (SELECT label, count(*) AS n FROM {name} GROUP BY label),
{name}_sum AS (SELECT i, label, sum(p) AS s FROM kernel JOIN {name} ON id = j GROUP BY i, label),
{name}_far AS (SELECT o.id, o.label AS own, z.label, z.n, 2 - 2 * coalesce(s, 0) / z.n AS d FROM {name} o CROSS JOIN {name}_size z
  LEFT JOIN {name}_sum t ON t.i = o.id AND t.label = z.label),
{name}_ab AS (SELECT id, max(CASE WHEN label = own THEN d * n / greatest(n - 1, 1) END) AS a, min(CASE WHEN label <> own THEN d END) AS b,
  max(CASE WHEN label = own THEN n END) AS n FROM {name}_far GROUP BY id)"""


def _online_batch(b: int) -> str:
    """Batch ``b`` of the online job: add, train, merge, expire, assign. Reads m{b}, the model before it; ends in m{b + 1} and a{b}."""
    known = " + ".join(["1", *[f"(SELECT count(*) FROM new{x})" for x in range(b)]])
    return f"""far{b} AS MATERIALIZED (SELECT v, s, row_number() OVER (ORDER BY id) AS r FROM vectors p WHERE batch_id = {b} AND s > 0
  AND NOT EXISTS (SELECT 1 FROM m{b} k WHERE list_distance(p.v, k.c) * list_distance(p.v, k.c) / p.s < 2.2)),
pass{b} AS (SELECT 0::BIGINT AS r, []::DOUBLE[][] AS admitted
  UNION ALL SELECT o.r, CASE WHEN len(list_filter(p.admitted, lambda a: list_distance(o.v, a) * list_distance(o.v, a) / o.s < 2.2)) = 0
    THEN list_append(p.admitted, o.v) ELSE p.admitted END FROM pass{b} p JOIN far{b} o ON o.r = p.r + 1),
taken{b} AS MATERIALIZED (SELECT admitted FROM pass{b} ORDER BY r DESC LIMIT 1),
new{b} AS MATERIALIZED (SELECT c, n - pos + {known} AS cluster_id FROM
  (SELECT unnest(admitted) AS c, generate_subscripts(admitted, 1) AS pos, len(admitted) AS n FROM taken{b})),
g{b} AS MATERIALIZED (SELECT cluster_id, c, w FROM m{b} UNION ALL SELECT cluster_id, c, 0.0 FROM new{b}),
hit{b} AS MATERIALIZED (SELECT cluster_id, v FROM (SELECT k.cluster_id, v, row_number() OVER (PARTITION BY id ORDER BY list_distance(v, k.c), k.cluster_id) AS place
  FROM vectors, g{b} k WHERE batch_id = {b} AND s > 0) WHERE place = 1),
sum{b} AS (SELECT cluster_id, i, sum(x) AS x, count(*) AS n FROM (SELECT cluster_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM hit{b}) GROUP BY cluster_id, i),
t{b} AS MATERIALIZED (SELECT o.cluster_id, list(CASE WHEN n IS NULL THEN c ELSE (0.7 * w * c + x) / (0.7 * w + n) END ORDER BY o.i) AS c,
  any_value(0.7 * w + coalesce(n, 0)) AS w FROM (SELECT cluster_id, w, unnest(c) AS c, generate_subscripts(c, 1) AS i FROM g{b}) o
  LEFT JOIN sum{b} s ON s.cluster_id = o.cluster_id AND s.i = o.i GROUP BY o.cluster_id),
pair{b} AS MATERIALIZED (SELECT i, j, wi, wj, row_number() OVER (ORDER BY i, j) AS r FROM (SELECT a.cluster_id AS i, b.cluster_id AS j, a.w AS wi, b.w AS wj,
  list_distance(a.c, b.c) AS d FROM t{b} a JOIN t{b} b ON a.cluster_id < b.cluster_id) WHERE d * d < 25),
merge{b} AS (SELECT 0::BIGINT AS r, []::BIGINT[] AS gone, []::STRUCT(k BIGINT, w DOUBLE)[] AS gains
  UNION ALL SELECT p.r,
    CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gone WHEN wi > wj THEN list_append(gone, j) ELSE list_append(gone, i) END,
    CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gains
      WHEN wi > wj THEN list_append(gains, {{'k': i, 'w': wj}}) ELSE list_append(gains, {{'k': j, 'w': wi}}) END
  FROM merge{b} s JOIN pair{b} p ON p.r = s.r + 1),
merged{b} AS MATERIALIZED (SELECT gone, gains FROM merge{b} ORDER BY r DESC LIMIT 1),
gain{b} AS (SELECT g.k AS cluster_id, sum(g.w) AS w FROM (SELECT unnest(gains) AS g FROM merged{b}) GROUP BY 1),
m{b + 1} AS MATERIALIZED (SELECT cluster_id, c, t.w + coalesce(q.w, 0) AS w FROM t{b} t LEFT JOIN gain{b} q USING (cluster_id), merged{b}
  WHERE NOT list_contains(gone, cluster_id) AND t.w + coalesce(q.w, 0) >= 1),
other{b} AS (SELECT cluster_id, other FROM (SELECT a.cluster_id, b.c AS other, row_number() OVER (PARTITION BY a.cluster_id
  ORDER BY list_distance(a.c, b.c), b.cluster_id) AS place FROM m{b + 1} a JOIN m{b + 1} b ON a.c <> b.c) WHERE place = 1),
a{b} AS (SELECT {b}::BIGINT AS batch_id, id, text, cluster_id, d * d / s AS own,
  list_distance(v, coalesce(other, c)) * list_distance(v, coalesce(other, c)) / s AS other FROM (SELECT id, text, v, s, k.cluster_id, k.c, list_distance(v, k.c) AS d,
    row_number() OVER (PARTITION BY id ORDER BY list_distance(v, k.c), k.cluster_id) AS place FROM vectors, m{b + 1} k WHERE batch_id = {b} AND s > 0)
  LEFT JOIN other{b} USING (cluster_id) WHERE place = 1)"""


_CUT = "row_number() OVER (ORDER BY doc_id) - 1) // (((SELECT count(*) FROM documents) + 2) // 3)"
ONLINE = f"""{TOKENS.replace("SELECT doc_id AS id, text,", f"SELECT doc_id AS id, text, ({_CUT} AS batch_id,", 1)},
sizes AS (SELECT batch_id, count(*) AS m FROM posts GROUP BY batch_id),
tf AS (SELECT batch_id, id, bucket, count(*) AS n FROM tokens JOIN vocabulary USING (word) JOIN posts USING (id) GROUP BY ALL),
idf AS (SELECT batch_id, bucket, ln((any_value(m) + 1) / (count(*) + 1)) AS idf FROM tf JOIN sizes USING (batch_id) GROUP BY batch_id, bucket),
weights AS (SELECT id, bucket, n * idf AS w FROM tf JOIN idf USING (batch_id, bucket)),
cells AS (SELECT p.batch_id, p.id, p.text, b.range AS b, coalesce(w.w, 0.0) AS x FROM posts p CROSS JOIN range(100) b
  LEFT JOIN weights w ON w.id = p.id AND w.bucket = b.range),
vectors AS MATERIALIZED (SELECT batch_id, id, any_value(text) AS text, list(x ORDER BY b) AS v, sum(x) AS s FROM cells GROUP BY batch_id, id),
m0 AS (SELECT 0::BIGINT AS cluster_id, []::DOUBLE[] AS c, 0.0::DOUBLE AS w WHERE false),
{", ".join(_online_batch(b) for b in range(3))},
assigned AS ({" UNION ALL ".join(f"SELECT * FROM a{b}" for b in range(3))}),
{_report('batch_id, cluster_id')}"""

SWEEP = (5, 10, 20)
# Two directions at once, kept orthogonal: products with the kernel, then Gram-Schmidt.
LSA = f"""{KERNEL},
lines AS MATERIALIZED (SELECT q.id AS i, list(coalesce(p, 0.0) ORDER BY o.id) AS r FROM points q CROSS JOIN points o
  LEFT JOIN kernel k ON k.i = q.id AND k.j = o.id GROUP BY q.id),
walk AS (SELECT 0 AS t, list(1.0::DOUBLE ORDER BY i) AS x, list(cos(i::DOUBLE) ORDER BY i) AS y FROM lines
  UNION ALL SELECT t + 1, list_transform(x, lambda v: v / sqrt(xx)) AS x, list_transform(z, lambda v: v / sqrt(list_dot_product(z, z))) AS y FROM (
    SELECT t, x, xx, list_transform(list_zip(x, y), lambda v: v[2] - xy / xx * v[1]) AS z FROM (
      SELECT *, list_dot_product(x, x) AS xx, list_dot_product(x, y) AS xy FROM (
        SELECT any_value(w.t) AS t, list(list_dot_product(r, w.x) ORDER BY i) AS x, list(list_dot_product(r, w.y) ORDER BY i) AS y FROM walk w, lines WHERE w.t < 600)
      WHERE t IS NOT NULL))),
done AS (SELECT x, y FROM walk ORDER BY t DESC LIMIT 1),
spots AS (SELECT i, list_dot_product(r, x) AS px, list_dot_product(r, y) AS py FROM lines, done),
scale AS (SELECT sqrt(sum(px * px)) AS sx, sqrt(sum(py * py)) AS sy FROM spots)"""

ORACLE = {
    # sources
    "read_posts": f"WITH {ALL_DOCS} SELECT id, text, CASE WHEN lang <> 'en' THEN source || ' ' || lang ELSE '' END AS urls, "
    "CASE WHEN lang <> 'en' THEN 2 ELSE 0 END::BIGINT AS n_urls FROM docs",
    "stream_posts": "SELECT doc_id AS id, length(text)::BIGINT AS chars, make_timestamp(doc_id * 1000000) AS ts FROM documents",
    "slice_batches": "SELECT id, r // 50 AS batch_index FROM (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS r "
    "FROM documents) WHERE r < 500",
    "time_batches": "SELECT time_bucket(INTERVAL '120 seconds', ts) AS batch_start, count(*) AS n, min(event_id) AS first_id "
    "FROM events GROUP BY 1",
    "lang_filter_source": "SELECT doc_id AS id, source, n_chars FROM documents WHERE lang = 'en'",
    "read_raw_events": "SELECT event_id AS id, unnest(['parsed', 'quarantined']) AS state FROM events",
    "read_terms": TERMS,
    "term_union": TERMS,
    "prepared_snapshot": "SELECT id, r // 40 AS batch_index, source FROM (SELECT doc_id AS id, source, "
    "row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents) WHERE r < 200",
    "take_n": "SELECT doc_id AS id, source, n_chars FROM documents ORDER BY doc_id LIMIT 500",
    "posts_table_scan": f"WITH {EVENT_POSTS} SELECT id, text, hashtags FROM kept ORDER BY id LIMIT 1000",
    # sinks
    "write_cluster_info": f"WITH {REPORT} SELECT batch_id, cluster_id, count, rep_id FROM report",
    "write_assignments": f"WITH {ASSIGNED} SELECT batch_id, cluster_id, id, text FROM assigned",
    "write_collisions": f"WITH {BATCH_COLLISIONS} SELECT batch_id, bucket, word FROM batch_words",
    "write_posts": f"WITH {EVENT_POSTS} SELECT id, text, text AS line_text, hashtags, NULL::VARCHAR AS urls, "
    "mention AS user_mentions FROM kept",
    "collect_stream": f"WITH {EVENT_POSTS} SELECT id, text, text AS line_text, author AS user_name, hashtags, NULL::VARCHAR AS urls, "
    "timestamp_ms AS timestamp, mention AS user_mentions FROM kept",
    "collect_quarantine": f"WITH {EVENT_POSTS} SELECT id, 'not JSON' AS reason FROM sent UNION ALL SELECT id, 'no id' FROM kept",
    "merge_sink": f"WITH {REPORT} SELECT batch_id, cluster_id, count FROM report",
    "reset_outputs": f"WITH {REPORT} SELECT run, count(*) AS rows FROM report, (SELECT unnest(['first', 'second']) AS run) GROUP BY run",
    "read_batch_outputs": f"WITH {ASSIGNED} SELECT batch_id, count(DISTINCT cluster_id) AS clusters, count(*)::BIGINT AS posts "
    "FROM assigned WHERE cluster_id IS NOT NULL GROUP BY batch_id",
    "read_merged": f"WITH {ASSIGNED} SELECT batch_id, cluster_id, count(*) AS posts, min(id) AS first_id FROM assigned "
    "WHERE cluster_id IS NOT NULL GROUP BY batch_id, cluster_id",
    # records
    "drop_control_records": "SELECT event_id AS id FROM events WHERE event_type <> 'error'",
    "flatten_quotes": """WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id, plain ORDER BY turn DESC, role DESC, text DESC) AS back
  FROM conversations, (VALUES (false), (true)) p(plain)),
f AS (SELECT conv_id, plain, max(turn) AS last, count(*) - 1 AS level, string_agg(text, ' @QUOTED: ' ORDER BY back) AS text,
  arg_max(role, back) AS author, count(*) FILTER (back > 1 AND role = 'system' AND NOT plain) AS other FROM t GROUP BY conv_id, plain)
SELECT conv_id * 1000 + last + CASE WHEN plain THEN 500 ELSE 0 END AS id, text, last::VARCHAR AS timestamp_ms, level, author
FROM f WHERE other = 0""",
    "extract_entities": f"WITH {EVENT_POSTS} SELECT id, hashtags, NULL::VARCHAR AS urls, mention AS mentions FROM kept",
    "project_post": f"WITH {EVENT_POSTS} SELECT id, text, author_id AS user_id, author AS user_name, followers AS followers_count, "
    "hashtags, NULL::VARCHAR AS urls, timestamp_ms AS timestamp, mention AS user_mentions FROM kept",
    "track_filter": f"WITH p AS (SELECT unnest([{', '.join(_text(p) for p in PHRASES)}]) AS term "
    "UNION ALL SELECT array_to_string(string_split(text, ' ')[1:2], ' ') FROM benchmark), "
    "q AS (SELECT list_filter(regexp_split_to_array(lower(term), '\\s+'), lambda w: w <> '') AS w FROM p) "
    f"SELECT id, lang FROM (SELECT doc_id AS id, lang, {SPLIT} AS t FROM documents) d WHERE EXISTS (SELECT 1 FROM q WHERE len(w) > 0 AND list_has_all(t, w))",
    "nonempty_guard": f"WITH {VECTORS} SELECT 1::BIGINT AS batch_id, count(*) FILTER (s > 0) AS posts, "
    "count(*) FILTER (s <= 0) AS unclustered FROM vectors",
    "empty_intervals": f"WITH {EMBEDDINGS} SELECT cluster_id, round(weight * 0.7 * 0.7, 6) AS weight FROM centers "
    "WHERE weight * 0.7 >= 20 AND weight * 0.7 * 0.7 >= 20",
    "filter_collisions": f"WITH {TOKENS}, v AS (SELECT word, {_bucket(20000)} AS bucket FROM vocabulary) SELECT * FROM "
    "(SELECT bucket, word, count(*) OVER (PARTITION BY bucket) AS n_words FROM v) WHERE n_words > 1",
    "interesting_flag": f"WITH {TOTALS} SELECT cluster_id, count, interesting FROM report",
    "interesting_history": f"WITH {HISTORY} SELECT batch_id, cluster_id, count, interesting FROM report WHERE cluster_id IN "
    "(SELECT cluster_id FROM report WHERE interesting)",
    "drilldown": f"WITH {ASSIGNED} SELECT batch_id, cluster_id, id, text FROM assigned WHERE cluster_id = 3 AND batch_id = 1",
    # text
    "tokenize": _words_of("w <> ''", "w"),
    "stem_tokens": _words_of("w <> ''", _stem("w")),
    "sanitize_tokens": _words_of(_kept("w"), _sanitize("w")),
    "remove_stopwords": _words_of(f"w <> '' AND w NOT IN {STOP}", "w"),
    "clean_tokens": f"WITH {POSTS}, t AS (SELECT id, list_filter(list_transform({SPLIT}, lambda w: {_sanitize(_stem('w'))}), "
    f"lambda w: {_kept('w')} AND w NOT IN {STOP}) AS t FROM posts) "
    "SELECT id, array_to_string(t, ' ') AS tokens, len(t)::BIGINT AS n FROM t",
    "hash_bucket": f"SELECT word, {_bucket(100)} AS bucket FROM (SELECT DISTINCT unnest({SPLIT}) AS word FROM documents)",
    "term_frequency": f"WITH {WEIGHTS} SELECT id, bucket, n FROM tf",
    "idf_weight": f"WITH {WEIGHTS} SELECT id, bucket, round(w, 6) AS w FROM weights WHERE w > 0",
    "collision_map": f"WITH {TOKENS} SELECT id, bucket, string_agg(word, ' ' ORDER BY word) AS words FROM "
    "(SELECT DISTINCT id, bucket, word FROM tokens JOIN vocabulary USING (word)) GROUP BY id, bucket",
    "collision_report": f"WITH {COLLISIONS} SELECT bucket, word, n_words FROM merged WHERE n_words > 1",
    "clean_text_regex": f"SELECT doc_id AS id, regexp_replace(text, {_text(LINKS_AND_MENTIONS)}, '', 'g') AS clean FROM documents",
    "stem_text": f"WITH {ALL_DOCS} SELECT id, array_to_string(list_transform(list_filter(regexp_split_to_array(text, '\\s+'), "
    f"lambda w: w <> ''), lambda w: {_stem('lower(w)')}), ' ') AS stemmed FROM docs",
    "tfidf_l2": f"WITH {TFIDF} SELECT id, word, round(w, 6) AS w FROM tfidf",
    # vectors and joins
    "sqdist": f"WITH {VECTORS} SELECT id, round(list_distance(v, c) * list_distance(v, c), 4) AS d FROM vectors JOIN centers "
    "ON cluster_id = source",
    "vector_sum": "SELECT vec_id AS id, round(list_sum(embedding::DOUBLE[]), 6) + 0.0 AS total FROM embeddings",
    "scaled_dist": f"WITH {VECTORS} SELECT id, CASE WHEN s > 0 THEN round(list_distance(v, c) * list_distance(v, c) / s, 4) END AS d "
    "FROM vectors JOIN centers ON cluster_id = source",
    "predict": f"WITH {EMBEDDINGS}, {_nearest('centers')} SELECT id, cluster_id, round(d * d, 6) AS dist FROM nearest",
    "round2": "SELECT CASE WHEN l_discount = 0 THEN 0.0 ELSE round(l_tax / l_discount, 2) END AS ratio, count(*) AS n "
    "FROM lineitem GROUP BY 1",
    "join_posts_clusters": f"WITH {ASSIGNED} SELECT id, cluster_id, length(text)::BIGINT AS chars FROM assigned",
    "join_vectors": f"WITH {ASSIGNED} SELECT v.id, cluster_id, round(s, 4) AS vec_sum, round(own, 4) AS own "
    "FROM vectors v JOIN assigned USING (id)",
    "join_neighbor": f"WITH {ASSIGNED} SELECT id, cluster_id, neighbor_id, round(other, 4) AS other FROM assigned "
    "WHERE cluster_id IS NOT NULL",
    "nearest_neighbor_center": f"WITH {EMBEDDINGS} SELECT cluster_id, neighbor_id, round(d * d, 6) AS dist FROM (SELECT a.cluster_id, "
    "b.cluster_id AS neighbor_id, list_distance(a.c, b.c) AS d, row_number() OVER (PARTITION BY a.cluster_id "
    "ORDER BY list_distance(a.c, b.c), b.cluster_id) AS r FROM centers a JOIN centers b ON a.cluster_id <> b.cluster_id) WHERE r = 1",
    "center_pairs": f"WITH {VECTORS} SELECT id_i, id_j, round(d, 4) AS dist FROM (SELECT a.cluster_id AS id_i, b.cluster_id AS id_j, "
    "list_distance(a.c, b.c) * list_distance(a.c, b.c) AS d FROM centers a JOIN centers b ON a.cluster_id < b.cluster_id) WHERE d < 25.0",
    "distant_candidates": f"WITH {ASSIGNED} SELECT id FROM assigned WHERE own >= 1.0",
    "mention_counts": f"WITH {EVENT_POSTS} SELECT mention AS user_name, count(*) AS mentions FROM kept GROUP BY mention",
    "top_mentions": f"WITH {EVENT_POSTS} SELECT mention AS user_name, count(*) AS mentions FROM kept GROUP BY mention "
    "ORDER BY mentions DESC, user_name LIMIT 20",
    "author_reach": f"WITH {EVENT_POSTS} SELECT user_name, mentions, followers_count FROM (SELECT mention AS user_name, count(*) AS mentions "
    "FROM kept GROUP BY mention) LEFT JOIN (SELECT author AS user_name, max(followers) AS followers_count FROM kept GROUP BY author) "
    "USING (user_name)",
    "duplicate_groups": f"WITH {GROUPS} SELECT id, rep_id, copies FROM groups",
    "propagate_labels": f"WITH {GROUPS} SELECT id, quality AS label FROM groups JOIN labels ON doc_id = rep_id",
    "update_labels": "SELECT d.doc_id AS id, source, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
    # quality
    "cluster_quality": f"WITH {TOTALS} SELECT * FROM report",
    "scaled_quality": f"WITH {TOTALS} SELECT cluster_id, count, round(intra, 4) AS intra, round(inter, 4) AS inter, "
    "round(silhouette, 4) + 0.0 AS silhouette FROM report_raw",
    "representative": f"WITH {TOTALS} SELECT cluster_id, rep_id, rep_text FROM report",
    "best_url": f"SELECT cluster_id, url AS best_url FROM (SELECT cluster_id, url, row_number() OVER (PARTITION BY cluster_id "
    f"ORDER BY n DESC, url DESC) AS r FROM (SELECT page_id % 10 AS cluster_id, {HOSTS} AS url, count(*) AS n FROM pages GROUP BY ALL)) "
    "WHERE r = 1",
    "batch_summary": f"WITH {REPORT} SELECT batch_id, sum(count)::BIGINT AS posts, count(*) AS clusters, "
    "count(*) FILTER (interesting) AS interesting, round(sum(count * silhouette) / sum(count), 6) AS avg_silhouette "
    "FROM report GROUP BY batch_id",
    "used_clusters": f"WITH {ASSIGNED} SELECT DISTINCT cluster_id FROM assigned WHERE cluster_id IS NOT NULL",
    "rank_by_silhouette": f"WITH {REPORT} SELECT batch_id, cluster_id, silhouette FROM report ORDER BY silhouette DESC, cluster_id",
    "collision_merge": f"WITH {COLLISIONS} SELECT bucket, word, n_words FROM merged",
    "cluster_sizes_topk": "SELECT source, count(*) AS size FROM documents GROUP BY source ORDER BY size DESC, source LIMIT 10",
    "cluster_cohesion": f"""WITH {WORDS},
per_word AS (SELECT source, word, count(*) AS c FROM counts GROUP BY ALL),
totals AS (SELECT source, sum(c) AS total FROM per_word GROUP BY source),
per_post AS (SELECT source, id, sum(c) AS hits FROM counts JOIN per_word USING (source, word) GROUP BY source, id),
sizes AS (SELECT source, count(*) AS size FROM posts GROUP BY source)
SELECT source AS cluster_id, round(coalesce(sum(hits / total), 0) / any_value(size), 6) AS score, any_value(size) AS size
FROM sizes LEFT JOIN per_post USING (source) LEFT JOIN totals USING (source) WHERE size > 1 GROUP BY source""",
    "top_cohesion": f"""WITH {GROUPS},
firsts AS (SELECT d.id, regexp_extract(source, '(\\d+)', 1)::BIGINT AS cluster_id, text, copies - 1 AS duplicates
  FROM docs d JOIN groups g ON g.id = d.id WHERE g.id = rep_id),
words AS (SELECT DISTINCT id, cluster_id, word FROM (SELECT id, cluster_id,
  unnest(regexp_extract_all(lower(text), {_text(WORD_PATTERN)})) AS word FROM firsts) WHERE word NOT IN {STOP}),
per_word AS (SELECT cluster_id, word, count(*) AS c FROM words GROUP BY ALL),
totals AS (SELECT cluster_id, sum(c) AS total FROM per_word GROUP BY cluster_id),
per_post AS (SELECT cluster_id, id, sum(c) AS hits FROM words JOIN per_word USING (cluster_id, word) GROUP BY ALL),
sizes AS (SELECT cluster_id, count(*) AS size, sum(duplicates)::BIGINT AS duplicates FROM firsts GROUP BY cluster_id)
SELECT cluster_id, round(score, 6) AS score, size, duplicates FROM (SELECT cluster_id,
  coalesce(sum(hits / total), 0) / any_value(size) AS score, any_value(size) AS size, any_value(duplicates) AS duplicates
  FROM sizes LEFT JOIN per_post USING (cluster_id) LEFT JOIN totals USING (cluster_id) WHERE size > 1 GROUP BY cluster_id)
ORDER BY score DESC, cluster_id LIMIT 5""",
    "hashtag_eval": """WITH r AS (SELECT event_id AS o, user_id % 10 AS c, event_type AS t FROM events),
f AS (SELECT *, first_value(t) OVER (PARTITION BY c ORDER BY o) AS ft,
  min(c) OVER (PARTITION BY t ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo,
  max(c) OVER (PARTITION BY t ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hi FROM r)
SELECT round(count(*) FILTER (t <> ft) / count(*), 6) AS within,
  round(count(*) FILTER (lo <> c OR hi <> c) / (count(*) * count(*)), 9) AS cross, 0::BIGINT AS empty FROM f""",
    "hashtag_eval_rows": """WITH r AS (SELECT event_id, user_id AS cluster, event_type || json_extract_string(props, '$.k') AS tag FROM events)
SELECT event_id, cluster, tag, tag <> first_value(tag) OVER (PARTITION BY cluster ORDER BY event_id) AS wrong_within,
  coalesce(min(cluster) OVER w <> cluster OR max(cluster) OVER w <> cluster, false) AS wrong_cluster FROM r
WINDOW w AS (PARTITION BY tag ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "top_terms": f"""WITH {TFIDF},
sizes AS (SELECT source, count(*) AS size FROM posts GROUP BY source ORDER BY size DESC, source LIMIT 10),
means AS (SELECT source, size, word, sum(w) / size AS weight FROM tfidf JOIN sizes USING (source) GROUP BY source, size, word)
SELECT * FROM (SELECT source AS cluster_id, size, row_number() OVER (PARTITION BY source ORDER BY round(weight, 9) DESC, word) AS rank,
  word, round(weight, 6) AS weight FROM means) WHERE rank <= 10""",
    "upsert_posts": "SELECT doc_id AS id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "vector_mean": f"WITH {EMBEDDINGS} SELECT cluster_id, count(*) AS n, round(sum(list_sum(v)), 4) + 0.0 AS total, "
    "round(sum(v[1]), 4) + 0.0 AS first FROM e GROUP BY cluster_id",
    "throughput": "SELECT count(*) AS posts, 0::BIGINT AS disagreements, true AS all_stored FROM documents",
    # history
    "batch_index": f"WITH {HISTORY} SELECT batch_id, batch_index FROM batches",
    "history_grid": f"WITH {HISTORY} SELECT cluster_id, batch_index, count, silhouette, rep_id, best_url FROM grid",
    "group_by_cluster": f"WITH {HISTORY} SELECT cluster_id, string_agg(batch_index || ':' || count, ' ' ORDER BY batch_index) AS cells "
    "FROM grid GROUP BY cluster_id",
    "post_link": f"WITH {REPORT} SELECT batch_id, cluster_id, 'https://posts.example/status/' || rep_id AS rep_link FROM report",
    "merge_cluster_info": f"WITH {REPORT} SELECT * FROM report",
    "merge_assignments": f"WITH {ASSIGNED} SELECT batch_id, cluster_id, id, text FROM assigned WHERE cluster_id IS NOT NULL",
    "merge_collisions": f"WITH {COLLISIONS} SELECT bucket, word, n_words FROM merged WHERE n_words > 1",
    # the online model
    "init_model": f"WITH {VECTORS} SELECT id FROM vectors WHERE s > 0",
    "add_clusters": f"WITH RECURSIVE {ADMITTED} SELECT n - pos + 1 AS cluster_id, 0.0::DOUBLE AS weight, "
    "round(list_sum(c), 4) AS total FROM numbered",
    "merge_clusters": f"WITH RECURSIVE {MERGED} SELECT id AS cluster_id, (weight + coalesce(w, 0))::DOUBLE AS weight "
    "FROM e LEFT JOIN gained USING (id), final WHERE NOT list_contains(gone, id)",
    "kmeans_batch": f"WITH {KERNEL}, {_kmeans(75, 'km')} SELECT id, label::INTEGER AS label FROM km",
    "silhouette_sweep": f"WITH {KERNEL}, {', '.join(_silhouette(k) for k in SWEEP)} "
    + " UNION ALL ".join(
        f"SELECT {k}::INTEGER AS k, round(avg(CASE WHEN n > 1 AND b IS NOT NULL THEN (b - a) / greatest(a, b) ELSE 0.0 END), 6) AS silhouette FROM k{k}_ab"
        for k in SWEEP
    ),
    "explore_clusters": f"""WITH {KERNEL}, {_kmeans(20, 'km')}, {GROUPS},
l AS (SELECT id, label::BIGINT AS cluster_id FROM km), sizes AS (SELECT cluster_id, count(*) AS size FROM l GROUP BY cluster_id),
words AS (SELECT cluster_id, word, row_number() OVER (PARTITION BY cluster_id ORDER BY round(sum(w) / any_value(size), 9) DESC, word) AS place
  FROM tfidf JOIN l USING (id) JOIN sizes USING (cluster_id) GROUP BY cluster_id, word),
tags AS (SELECT cluster_id, source, first_value(source) OVER (PARTITION BY cluster_id ORDER BY id) AS first FROM l JOIN posts USING (id)),
wrong AS (SELECT cluster_id, count(*) FILTER (source <> first) AS wrong FROM tags GROUP BY cluster_id),
per_word AS (SELECT cluster_id, word, count(*) AS c FROM counts JOIN l USING (id) GROUP BY ALL),
cohesion AS (SELECT cluster_id, round(sum(c * c) / sum(c) / any_value(size), 6) AS score FROM per_word JOIN sizes USING (cluster_id) WHERE size > 1 GROUP BY cluster_id),
copies AS (SELECT cluster_id, count(*) AS with_copies FROM groups g JOIN l ON l.id = g.rep_id GROUP BY cluster_id)
SELECT cluster_id, size, word AS top_word, wrong, score, with_copies FROM sizes LEFT JOIN (SELECT * FROM words WHERE place = 1) USING (cluster_id)
LEFT JOIN wrong USING (cluster_id) LEFT JOIN cohesion USING (cluster_id) LEFT JOIN copies USING (cluster_id)""",
    # a post's place on a direction is the product of its line of the kernel with the direction, over the root of its length
    "lsa_reduce": f"WITH RECURSIVE {LSA} SELECT i AS id, round(abs(px / sqrt(sx)) / sqrt(px * px / sx + py * py / sy), 4) AS x, "
    "round(abs(py / sqrt(sy)) / sqrt(px * px / sx + py * py / sy), 4) AS y FROM spots, scale",
    "dbscan": f"WITH RECURSIVE {DBSCAN} SELECT p.id, coalesce(l.label, b.label, -1) AS label FROM points p "
    "LEFT JOIN labels_of l USING (id) LEFT JOIN border b USING (id)",
    "model_append": f"WITH {EMBEDDINGS} SELECT cluster_id, weight FROM centers UNION ALL SELECT cluster_id + 100, 0.0 FROM centers",
    "model_remove": f"WITH {EMBEDDINGS} SELECT cluster_id, weight FROM centers WHERE weight >= (SELECT avg(weight) FROM centers)",
    "train_step": f"WITH {TRAINED} SELECT cluster_id, round(any_value(weight), 4) AS weight, round(sum(c), 6) + 0.0 AS total, "
    "round(sum(c * c), 6) AS norm2 FROM trained GROUP BY cluster_id",
    "expire_clusters": f"WITH {TRAINED}, w AS (SELECT cluster_id, any_value(weight) AS weight FROM trained GROUP BY cluster_id) "
    "SELECT cluster_id, round(weight, 4) AS weight FROM w WHERE weight >= (SELECT avg(weight) FROM w)",
    "keep_one": f"WITH RECURSIVE {ADMITTED} SELECT n + n - pos + 1 AS cluster_id FROM numbered",
    "init_random": """WITH f AS (SELECT count(DISTINCT label) AS k, max(len(embedding)) AS dims, max(label) + 1 AS first FROM embeddings WHERE label IS NOT NULL),
c AS (SELECT unnest(range(first, first + k))::BIGINT AS cluster_id, dims FROM f), d AS (SELECT cluster_id, unnest(range(dims)) AS i FROM c),
u AS (SELECT *, (('0x' || substr(md5('7:' || cluster_id || ':' || (i + 1) || ':r'), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS r,
  (('0x' || substr(md5('7:' || cluster_id || ':' || (i + 1) || ':a'), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS a FROM d)
SELECT cluster_id, 2.0::DOUBLE AS weight, i::INTEGER AS i, round(sqrt(-2 * ln(r)) * cos(2 * pi() * a), 6) AS x FROM u""",
    "run_stream": f"WITH RECURSIVE {ONLINE} SELECT batch_id, cluster_id, count, silhouette, intra, inter, interesting, rep_id, best_url FROM report",
    "stable_id": f"WITH {EMBEDDINGS}, heavy AS (SELECT * FROM centers WHERE weight >= (SELECT avg(weight) FROM centers)), "
    f"{_nearest('heavy')} SELECT id, cluster_id FROM nearest",
    "assign_after_update": f"WITH {VECTORS} SELECT count(*) AS posts, 0::BIGINT AS differences FROM vectors WHERE s > 0",
}
