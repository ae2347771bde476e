"""DuckDB SQL for those queries that SQL can express over whole tables."""

from tidemark.llm.urls import SQL as OP4

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _runs(words: str, width: int) -> str:
    """All runs of ``width`` words of a list, or the whole list when it is shorter."""
    return (
        f"CASE WHEN len({words}) = 0 THEN [] WHEN len({words}) < {width} THEN [array_to_string({words}, ' ')] "
        f"ELSE list_transform(range(1, len({words}) - {width} + 2), "
        f"lambda i: array_to_string({words}[i:i + {width} - 1], ' ')) END"
    )


#: Links, then everything reachable from each row.
_REACHED = """
    reached(a, b) AS (
        SELECT a, b FROM linked UNION SELECT reached.a, linked.b FROM reached JOIN linked ON reached.b = linked.a)
"""

OP1 = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
linked AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    AND list_cosine_similarity(x.v, y.v) >= 0.98),
{_REACHED}
SELECT vec_id,
       (SELECT count(*) FROM linked WHERE a = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(b) FROM reached WHERE a = vec_id), vec_id)) AS component_id,
       vec_id <= coalesce((SELECT min(b) FROM reached WHERE a = vec_id), vec_id) AS kept
FROM embeddings
"""

OP6 = f"""
WITH RECURSIVE sets AS (
    SELECT doc_id, list_distinct({_runs('w', 5)}) AS s
    FROM (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS w FROM documents)),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS o
    FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
linked AS (SELECT a, b FROM common WHERE 100 * o >= 80 * (n + m - o)),
{_REACHED}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce((SELECT min(b) FROM reached WHERE a = doc_id), doc_id)) AS component_id
FROM sets
"""

OP9 = f"""
WITH items AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS size, unnest({_runs('w', 10)}) AS g
    FROM (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark)),
docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM items),
spots AS (
    SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w
    FROM docs, sizes WHERE len(w) >= size),
hits AS (
    SELECT doc_id, spots.i, spots.size, item
    FROM spots JOIN items ON items.size = spots.size AND items.g = array_to_string(w[i:i + spots.size - 1], ' ')),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS word FROM hits),
named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS found FROM hits GROUP BY 1)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       (SELECT count(*) FROM covered WHERE covered.doc_id = docs.doc_id) AS n_hit,
       CAST(coalesce(len(found), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(found, ','), '')) AS items_sha256,
       found IS NOT NULL AS contaminated
FROM docs LEFT JOIN named ON named.doc_id = docs.doc_id
"""


def _seats(parts: str, group: str, share: str, order: str) -> str:
    """Sainte-Lague: the ``seats`` highest quotients of each group. ``parts`` names a relation
    that has them; quotients are listed as far as a part can possibly win."""
    return f"""
    SELECT * EXCLUDE (k, q, r) FROM (
        SELECT *, {share} / (2 * k + 1) AS q,
               row_number() OVER (PARTITION BY {group} ORDER BY {share} / (2 * k + 1) DESC, {order} NULLS LAST, k) AS r
        FROM (SELECT *, unnest(range(CAST(ceil({share} / whole * seats) + parts + 1 AS BIGINT))) AS k
              FROM (SELECT *, sum({share}) OVER (PARTITION BY {group}) AS whole,
                           count(*) OVER (PARTITION BY {group}) AS parts FROM {parts})
              WHERE whole > 0 AND {share} > 0))
    WHERE r <= seats
    """


OP2 = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_SPACED})) AS size,
           md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
sources AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
           source_size * 3 AS most
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS rows FROM sized GROUP BY 1)),
filled AS (
    SELECT *, row_number() OVER fill AS nth,
           (sum(source_size) OVER () - (sum(most) OVER fill - most))::DOUBLE
               / (sum(weight) OVER () - (sum(weight) OVER fill - weight)) AS level
    FROM sources WINDOW fill AS (ORDER BY most / weight, source NULLS LAST)),
wanted AS (
    SELECT source, source_size, rows, CAST(ceil(rows / 1024) AS BIGINT) AS shards,
           least(l * weight, most::DOUBLE) AS target
    FROM filled, (SELECT arg_min(level, nth) AS l FROM filled WHERE level * weight <= most)),
asked AS (SELECT *, CAST(round((SELECT sum(target) FROM wanted) / 16) AS BIGINT) AS seats FROM wanted),
quotas AS (
    SELECT wanted.*, coalesce(n, 0) AS quota FROM wanted LEFT JOIN (
        SELECT source AS s, count(*) AS n FROM ({_seats('asked', '1', 'target', 'source')}) GROUP BY 1
    ) ON s IS NOT DISTINCT FROM source),
dealt AS (
    SELECT sized.*, source_size, target, quota, ('0x' || substr(digest, 1, 8))::BIGINT % shards AS shard
    FROM sized JOIN quotas ON sized.source IS NOT DISTINCT FROM quotas.source),
shards AS (
    SELECT source, shard, quota AS seats, sum(size)::DOUBLE AS shard_size FROM dealt GROUP BY ALL),
won AS (SELECT source AS s, shard AS k, count(*) AS n FROM ({_seats('shards', 'source', 'shard_size', 'shard')}) GROUP BY ALL),
placed AS (
    SELECT dealt.*, CAST(shard_size AS BIGINT) AS z,
           least(coalesce(n, 0) * 16, CAST(shard_size AS BIGINT) * 3) AS words,
           sum(size) OVER (PARTITION BY dealt.source, dealt.shard ORDER BY digest, doc_id, size
                           ROWS UNBOUNDED PRECEDING) - size AS front
    FROM dealt JOIN shards ON shards.source IS NOT DISTINCT FROM dealt.source AND shards.shard = dealt.shard
    LEFT JOIN won ON s IS NOT DISTINCT FROM dealt.source AND k = dealt.shard)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN z > 0 THEN size * (words // z)
            + greatest(0, least(words - (words // z) * z - front, size)) ELSE 0 END AS BIGINT) AS taken
FROM placed
"""


OP12 = f"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
stats AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM split WHERE len(w) > 0),
counts AS (
    SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM split) GROUP BY ALL),
terms AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, {_ALNUM})) AS t FROM benchmark),
weighed AS (
    SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM counts, stats GROUP BY t),
scored AS (
    SELECT item_id, r, doc_id,
           CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)))) AS BIGINT) AS score
    FROM terms JOIN counts USING (t) JOIN weighed USING (t), stats GROUP BY ALL),
ranked AS (
    SELECT item_id, doc_id, score,
           CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
