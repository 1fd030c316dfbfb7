"""SQL for the queries whose results SQL can express, by plain enumeration."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Smallest node that is reachable over the symmetric table ``link`` (a, b).
_REACH = """reach(node, root) AS (SELECT DISTINCT a, a FROM link
  UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.node),
low AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""

NGRAM_JACCARD = f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACED}') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM common JOIN sizes m ON m.doc_id = a JOIN sizes o ON o.doc_id = b
  WHERE 100 * k >= 75 * (m.n + o.n - k)),
{_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id FROM documents d
  LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN low ON low.node = d.doc_id"""

EMBEDDINGS = f"""WITH RECURSIVE link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a
  JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.98),
{_REACH}
SELECT v.vec_id, (SELECT count(*) FROM link WHERE a = v.vec_id) AS n_links, coalesce(root, v.vec_id) AS component_id,
  coalesce(root, v.vec_id) = v.vec_id AS kept FROM embeddings v LEFT JOIN low ON node = v.vec_id"""

SUBSTRINGS = f"""WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)),
first AS (SELECT g, min(doc_id) AS doc_id FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM (
  SELECT windows.doc_id, i FROM windows JOIN first ON first.g = windows.g WHERE first.doc_id < windows.doc_id)),
places AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM words)),
kept AS (SELECT places.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY places.p) AS text FROM places
  LEFT JOIN gone ON gone.doc_id = places.doc_id AND gone.p = places.p WHERE gone.p IS NULL GROUP BY places.doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256 FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id"""

DECONTAMINATION = f"""WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS k FROM (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark)),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
  SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items WHERE k > 0)),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, i, places.k FROM places JOIN windows ON windows.k = places.k AND windows.g = places.g),
spread AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(spread.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(spread.n, 0) > 0 AS contaminated FROM words
  LEFT JOIN spread ON spread.doc_id = words.doc_id LEFT JOIN named ON named.doc_id = words.doc_id"""

# CRC-32 has no function here: its table follows from the reversed polynomial, bit by bit.
SHARDS = """WITH RECURSIVE step(i, k, c) AS (SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END
  FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
sized AS (SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size, coalesce(substr(md5(text), 1, 16), '') AS key,
  CASE WHEN text IS NOT NULL THEN xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
    range(strlen(text)), lambda i: ('0x' || substr(hex(text), 2 * i + 1, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, list_extract(t, (xor(c, b) & 255)::BIGINT + 1))), 4294967295::UBIGINT) END AS text_crc32 FROM documents, crc),
placed AS (SELECT *, sum(size) OVER (ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total
  FROM sized),
cut AS (SELECT *, ((2 * upto - size) * {shards}) // (2 * total) AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot, NULL::INT AS grown_shard FROM cut"""


def _centroids(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Lloyd's rounds written out one after the other."""
    steps = [
        f"""points AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, i, v[i] AS x FROM (SELECT vec_id, v, unnest(range(1, {size} + 1)) AS i FROM points))""",
        f"""first AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c, v FROM points
  QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) <= {k})""",
        f"centre0 AS MATERIALIZED (SELECT c, i, v[i] AS y FROM (SELECT c, v, unnest(range(1, {size} + 1)) AS i FROM first))",
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT vec_id, c, d FROM (SELECT vec_id, c, sum((x - y) * (x - y))::BIGINT AS d
    FROM parts JOIN centre{r} USING (i) GROUP BY vec_id, c) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""centre{r + 1} AS MATERIALIZED (SELECT c, i, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, y) AS y
  FROM centre{r} LEFT JOIN (SELECT c, i, sum(x) AS s, count(*) AS n FROM parts JOIN near{r} USING (vec_id) GROUP BY c, i)
  USING (c, i))""")
    return f"""WITH {", ".join(steps)},
named AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM centre{rounds} GROUP BY c)
SELECT vec_id, c::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, centroid_sha256 FROM near{rounds} JOIN named USING (c)"""


CENTROIDS = _centroids()

NEGATIVES = """WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
near AS (SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
hard AS (SELECT near.anchor_id, near.other AS positive_id, near.score AS positive_score, far.other AS negative_id,
    far.score AS negative_score,
    row_number() OVER (PARTITION BY near.anchor_id, near.other ORDER BY far.score DESC, far.other) AS rank
  FROM near JOIN scored far ON far.anchor_id = near.anchor_id AND NOT far.same
    AND 30 * near.score <= 100 * far.score AND 100 * far.score <= 90 * near.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 10"""
