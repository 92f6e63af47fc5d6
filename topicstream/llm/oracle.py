"""SQL counterparts of the training-data queries that SQL can express."""

from topicstream.llm.spotsigs import ANCHORS, COMMON

ORACLE: dict[str, str] = {}

BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
# five hexadecimal digits are four base-32 digits
_DIGITS = " || ".join(
    f"substr({BASE32}, ((('0x' || substr(h, {5 * i + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0)
)

ORACLE["op1_warc_dictionary"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f"""

# Components: the smallest id reachable, by the links found in either direction.
_REACHED = """
r AS (SELECT a AS node, a AS seen FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
m AS (SELECT node, min(seen) AS least FROM r GROUP BY node)"""

ORACLE["op3_product_quantised_dedup"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0
), l AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_dot_product(p.x, q.x) / (sqrt(list_dot_product(p.x, p.x)) * sqrt(list_dot_product(q.x, q.x))) >= 0.98
), n AS (SELECT a, count(*) AS n FROM l GROUP BY a), {_REACHED}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least(least, vec_id), vec_id) AS component_id,
       coalesce(least(least, vec_id), vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN m ON m.node = vec_id"""

ORACLE["op4_minhash_near_dedup"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
l AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM e p JOIN e q ON p.shingle = q.shingle AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), {_REACHED}
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(least(least, doc_id), doc_id) AS component_id,
       coalesce(least(least, doc_id), doc_id) = doc_id AS kept
FROM s LEFT JOIN m ON m.node = doc_id"""

# The given pages mark their article, so its blocks are the main text.
ORACLE["op6_line_block_html"] = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS body FROM pages
), b AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|h1|br)>', chr(10), 'g'), '<[^>]*>', '', 'g') AS body FROM a
), e AS (
  SELECT page_id, url, replace(replace(replace(replace(body, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS body FROM b
), t AS (
  SELECT page_id, url, trim(regexp_replace(body, '\s+', ' ', 'g')) AS text FROM e
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t"""


def _listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


ORACLE["op7_spotsigs"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (
  SELECT *, coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id FROM d
), e AS (
  SELECT o.doc_id, o.text, o.n, o.next_id, substr(o.text, 1, o.n - o.n // 3) || substr(x.text, 1, o.n // 3) AS edited
  FROM o JOIN d x ON x.doc_id = o.next_id
), t AS (SELECT doc_id, 0 AS kind, text FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
a AS (SELECT doc_id, kind, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws FROM t),
w AS (SELECT doc_id, kind, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM a),
m AS (
  SELECT *, word IN ({_listed(ANCHORS)}) AS anchor, word IN ({_listed([*ANCHORS, *COMMON])}) AS common FROM w
), k AS (
  SELECT *, sum(CASE WHEN common THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS k FROM m
), c AS (SELECT doc_id, kind, k, word FROM k WHERE NOT common),
s AS (
  SELECT x.doc_id, x.kind, x.word || ':' || c1.word || coalesce(':' || c2.word, '') AS spot
  FROM k x JOIN c c1 ON c1.doc_id = x.doc_id AND c1.kind = x.kind AND c1.k = x.k + 1
  LEFT JOIN c c2 ON c2.doc_id = x.doc_id AND c2.kind = x.kind AND c2.k = x.k + 2
  WHERE x.anchor
), spotted AS (SELECT DISTINCT doc_id, kind FROM s),
worded AS (SELECT DISTINCT doc_id, kind FROM w),
keys AS (
  SELECT DISTINCT doc_id, kind, spot FROM s
  UNION ALL SELECT DISTINCT doc_id, kind, word FROM w ANTI JOIN spotted USING (doc_id, kind)
  UNION ALL SELECT doc_id, kind, text FROM t ANTI JOIN worded USING (doc_id, kind)
), f AS (
  SELECT doc_id, kind, list_sort(list(('0x' || substr(md5(spot), 1, 15))::BIGINT)) AS spots FROM keys GROUP BY ALL
), j AS (
  SELECT e.doc_id, e.n, e.edited, f.spots AS own, g.spots AS edit, h.spots AS nxt,
         len(list_intersect(f.spots, g.spots)) AS ce, len(list_intersect(f.spots, h.spots)) AS cn
  FROM e JOIN f ON f.doc_id = e.doc_id AND f.kind = 0
  JOIN f g ON g.doc_id = e.doc_id AND g.kind = 1
  JOIN f h ON h.doc_id = e.next_id AND h.kind = 0
)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(own, ' ') AS fingerprint, array_to_string(edit, ' ') AS edited_fingerprint,
       ce::DOUBLE / (len(own) + len(edit) - ce) AS near_edited, cn::DOUBLE / (len(own) + len(nxt) - cn) AS near_next
FROM j"""

# Lloyd rounds: whole numbers below 2^53, so sums of products of doubles are exact.
_NEAREST = """
d{r} AS MATERIALIZED (
  SELECT p.row, p.pos, p.x, arg_min(b.e, (list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, b.x) + list_dot_product(b.x, b.x)) * 256 + b.e) AS e,
         min(list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, b.x) + list_dot_product(b.x, b.x)) AS err
  FROM p JOIN b{r} b USING (pos) GROUP BY p.row, p.pos, p.x
)"""
_MOVED = """,
b{n} AS MATERIALIZED (
  WITH m AS (SELECT pos, e, x[i] AS v, i FROM d{r}, range(1, 1 + (SELECT w FROM width)) t(i)),
  a AS (SELECT pos, e, i, floor(sum(v) / count(*)) AS v FROM m GROUP BY ALL),
  l AS (SELECT pos, e, list(v ORDER BY i) AS x FROM a GROUP BY ALL)
  SELECT b.pos, b.e, coalesce(l.x, b.x) AS x FROM b{r} b LEFT JOIN l USING (pos, e)
)"""

ORACLE["op11_member_lloyd"] = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x, row_number() OVER (ORDER BY vec_id) AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), width AS (SELECT (max(len(x)) // 4)::BIGINT AS w FROM v),
p AS MATERIALIZED (SELECT row, pos, list_slice(x, pos * w + 1, (pos + 1) * w) AS x FROM v, width, range(4) t(pos)),
b0 AS MATERIALIZED (SELECT pos, row - 1 AS e, x FROM p WHERE row <= 256),
{",".join(_NEAREST.format(r=r) + (_MOVED.format(r=r, n=r + 1) if r < 4 else "") for r in range(5))},
c AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY pos) AS code, sum(err)::BIGINT AS error FROM d4 GROUP BY row),
s AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: c::BIGINT), ','), ',' ORDER BY pos, e)) AS codebooks_sha256 FROM b4)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN c USING (row), s"""


def _crc_table() -> list[int]:
    """The 256 steps of crc32, from its polynomial."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op12_importance_resampling"] = f"""
WITH w AS (
  SELECT doc_id, 0 AS aim, {_WORDS} AS w FROM documents UNION ALL SELECT item_id, 1, {_WORDS} FROM benchmark
), g AS MATERIALIZED (
  SELECT doc_id, aim, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f FROM w
), h AS (SELECT DISTINCT f, hex(f) AS x FROM g),
k AS MATERIALIZED (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda s, b: xor(s >> 8, ({_crc_table()}::BIGINT[])[(xor(s, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket FROM h
), c AS (SELECT bucket, count(*) FILTER (aim = 0) AS s, count(*) FILTER (aim = 1) AS t FROM g JOIN k USING (f) GROUP BY bucket),
a AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM c),
n AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT AS gain FROM c, a
), d AS (
  SELECT doc_id, count(*)::BIGINT AS n_features, sum(gain)::BIGINT AS weight FROM g JOIN k USING (f) JOIN n USING (bucket) WHERE aim = 0 GROUP BY doc_id
), r AS (
  SELECT w.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN d ON d.doc_id = w.doc_id WHERE aim = 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM r
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM o"""

ORACLE["op13_winnowing"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
i AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda k: array_to_string(w[k : k + least(len(w), 10) - 1], ' '))) AS win
  FROM b WHERE len(w) > 0
), z AS (SELECT DISTINCT size FROM i),
p AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS spot, unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k : k + size - 1], ' '))) AS win
  FROM d, z
), f AS MATERIALIZED (SELECT doc_id, spot, size, win FROM p SEMI JOIN i USING (size, win)),
h AS (SELECT doc_id, count(DISTINCT spot + k) AS n_hit FROM f, range(10) t(k) WHERE k < size GROUP BY doc_id),
n AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM f JOIN i USING (size, win)) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
