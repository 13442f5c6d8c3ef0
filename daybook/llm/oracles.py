"""What the queries of this subpackage must return, as SQL for DuckDB over the given tables.

Each says what its contract says, by plain joins and windows; nothing of the operators' methods.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"


def _words(text: str = "text", table: str = "documents") -> str:
    """doc_id, i (from 1), w: every word."""
    return f"""
    SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w
    FROM (SELECT doc_id, regexp_extract_all(coalesce({text}, ''), '{_WORD}') AS ws FROM {table}) t"""


def _joined_leads(column: str, n: int, glue: str) -> str:
    """A column and the n - 1 after it, in one text."""
    return f" || {glue} || ".join([column, *(f"lead({column}, {k}) OVER o" for k in range(1, n))])


ORACLES["op1_substring_dedup"] = f"""
WITH words AS MATERIALIZED ({_words()}),
windows AS (
    SELECT doc_id, i, {_joined_leads("w", 13, "' '")} AS k FROM words
    WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
firsts AS (SELECT k, min(doc_id) AS d FROM windows WHERE k IS NOT NULL GROUP BY k),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
    FROM windows JOIN firsts USING (k) WHERE d < doc_id
),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id)
SELECT doc_id, coalesce(s.n, 0) AS n_words, coalesce(s.n, 0) - coalesce(k.n, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents LEFT JOIN sizes s USING (doc_id) LEFT JOIN kept k USING (doc_id)"""


def _components(nodes: str, node: str, links: str) -> str:
    """CTE classes (node, least): the smallest node that each can reach; links (a, b) go both ways."""
    return f"""
reach AS (
    SELECT {node} AS node, {node} AS other FROM {nodes}
    UNION
    SELECT r.node, l.b FROM reach r JOIN {links} l ON r.other = l.a
),
classes AS (SELECT node, min(other) AS least FROM reach GROUP BY node)"""


ORACLES["op3_embedding_dedup"] = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
          AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0
),
links AS MATERIALIZED (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id
    WHERE len(x.v) = len(y.v)
          AND list_inner_product(x.v, y.v)
              / sqrt(list_inner_product(x.v, x.v) * list_inner_product(y.v, y.v)) >= 0.95
),
{_components("embeddings", "vec_id", "links")},
numbers AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least AS component_id, vec_id = least AS kept
FROM embeddings JOIN classes ON vec_id = node LEFT JOIN numbers ON vec_id = a"""

ORACLES["op4_minhash_dedup"] = f"""
WITH RECURSIVE words AS MATERIALIZED ({_words()}),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
shingles AS MATERIALIZED (
    SELECT doc_id, s, count(*) AS n FROM (
        SELECT doc_id, {_joined_leads("w", 5, "' '")} AS s FROM words
        WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        UNION ALL
        SELECT doc_id, string_agg(w, ' ' ORDER BY i) FROM words JOIN sizes USING (doc_id)
        WHERE n < 5 GROUP BY doc_id
    ) t WHERE s IS NOT NULL GROUP BY doc_id, s
),
totals AS (SELECT doc_id, sum(n) AS total FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
    SELECT a, b FROM common JOIN totals p ON a = p.doc_id JOIN totals q ON b = q.doc_id
    WHERE 10 * c >= 8 * (p.total + q.total - c)
),
{_components("documents", "doc_id", "links")}
SELECT doc_id, least AS class_id, doc_id = least AS kept FROM documents JOIN classes ON doc_id = node"""


def _line_runs(least: int = 5) -> str:
    """Shortest runs of lines with a word that have ``least`` words: all that any longer run needs."""
    parts = []
    for m in range(1, least + 1):
        total = " + ".join(["n", *(f"lead(n, {k}) OVER o" for k in range(1, m))])
        parts.append(
            f"""
    SELECT doc_id, i, place, {m} AS m, {_joined_leads("line", m, "chr(10)")} AS k, {total} AS total,
           n AS head, lead(n, {m - 1}) OVER o AS tail
    FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)"""
        )
    return "\n    UNION ALL".join(parts)


ORACLES["op9_line_dedup"] = f"""
WITH lines AS MATERIALIZED (
    SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL) t
),
placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place
    FROM (SELECT *, len(regexp_extract_all(line, '{_WORD}')) AS n FROM lines) t WHERE n > 0
),
runs AS MATERIALIZED (
    SELECT * FROM ({_line_runs()}
    ) t WHERE k IS NOT NULL AND total >= 5 AND (total - tail < 5 OR total - head < 5)
),
firsts AS (SELECT m, k, min((doc_id, i)) AS first FROM runs GROUP BY m, k),
gone AS (
    SELECT DISTINCT p.doc_id, p.i
    FROM runs r JOIN firsts f ON r.m = f.m AND r.k = f.k AND (r.doc_id, r.i) > f.first
    JOIN placed p ON p.doc_id = r.doc_id AND p.place BETWEEN r.place AND r.place + r.m - 1
),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
    FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
),
sizes AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id)
SELECT doc_id, coalesce(s.n, 0) AS n_lines, coalesce(r.n, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN removed r USING (doc_id)
     LEFT JOIN kept k USING (doc_id)"""

# The CRC-32 of a text of digits, by its table of 256 values (reflected polynomial 0xEDB88320).
_CRC = """
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_concat([i], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
hashed AS (
    SELECT doc_id, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM documents, crc_table
)"""

# A run of period q has three multiples of q, one after the other, where words q apart are equal;
# only for the periods that this leaves are all words compared.
ORACLES["op11_periodic_runs"] = f"""
WITH original AS MATERIALIZED (SELECT doc_id, i - 1 AS i, w FROM ({_words()}) t),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM original GROUP BY doc_id),
{_CRC},
planted AS (
    SELECT doc_id, n, h // 10 % n AS a,
           1 + (n - h // 10 % n) // (3 + h // 10 % 8) AS p
    FROM hashed JOIN sizes USING (doc_id) WHERE h % 10 = 0
),
words AS MATERIALIZED (
    SELECT o.doc_id, o.i, o.w FROM original o ANTI JOIN planted USING (doc_id)
    UNION ALL
    SELECT t.doc_id, t.i, o.w
    FROM (SELECT doc_id, a, p, unnest(range(n)) AS i FROM planted) t
    JOIN original o ON o.doc_id = t.doc_id AND o.i = CASE WHEN t.i < a THEN t.i ELSE a + (t.i - a) % p END
),
lags AS (SELECT doc_id, n, unnest(range(1, n // 4 + 1)) AS q FROM sizes),
steps AS (SELECT doc_id, q, unnest(range(0, (n - 1) // q)) AS k FROM lags),
hits AS MATERIALIZED (
    SELECT s.doc_id, s.q, s.k FROM steps s
    JOIN words x ON x.doc_id = s.doc_id AND x.i = s.k * s.q
    JOIN words y ON y.doc_id = s.doc_id AND y.i = (s.k + 1) * s.q AND y.w = x.w
),
periods AS (
    SELECT DISTINCT x.doc_id, x.q FROM hits x
    JOIN hits y ON y.doc_id = x.doc_id AND y.q = x.q AND y.k = x.k + 1
    JOIN hits z ON z.doc_id = x.doc_id AND z.q = x.q AND z.k = x.k + 2
),
equal AS (
    SELECT p.doc_id, p.q, x.i FROM periods p
    JOIN words x ON x.doc_id = p.doc_id
    JOIN words y ON y.doc_id = p.doc_id AND y.i = x.i + p.q AND y.w = x.w
),
stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) t
    GROUP BY doc_id, q, island
),
runs AS MATERIALIZED (
    SELECT doc_id, start, length, min(q) AS q FROM stretches
    WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length
),
told AS (
    SELECT doc_id, count(*) AS n_runs,
           max((length, -start, -q)) AS best,
           string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed
    FROM runs GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best[2] AS start, best[1] AS length, -best[3] AS period,
       1000 * best[1] // -best[3] AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told USING (doc_id) LEFT JOIN (SELECT doc_id, text FROM kept) k USING (doc_id)"""
ORACLES["op11_periodic_runs"] = ORACLES["op11_periodic_runs"].replace(
    "FROM documents d LEFT", "FROM (SELECT doc_id FROM documents) d LEFT"
)


def _round(number: int, last: bool = False) -> str:
    """One round: nearest centroids, then new ones; the last only assigns."""
    nearest = f"""
near{number} AS MATERIALIZED (
    SELECT vec_id, min((distance, cluster)) AS best FROM (
        SELECT vec_id, cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
        FROM vectors v JOIN centroids{number} c USING (dim) GROUP BY vec_id, cluster
    ) t GROUP BY vec_id
)"""
    if last:
        return nearest
    return f"""{nearest},
means{number} AS (
    SELECT best[2] AS cluster, dim, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM near{number} JOIN vectors USING (vec_id) GROUP BY ALL
),
centroids{number + 1} AS MATERIALIZED (
    SELECT cluster, dim, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x
    FROM centroids{number} LEFT JOIN means{number} USING (cluster, dim)
)"""


ORACLES["op12_centroid_clusters"] = f"""
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
),
vectors AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS dim, unnest(v) AS x FROM usable),
first AS (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster
    FROM usable ORDER BY cluster LIMIT 40
),
centroids0 AS MATERIALIZED (SELECT cluster, dim, x FROM first JOIN vectors USING (vec_id)),
{",".join(_round(k) for k in range(5))},
{_round(5, last=True)},
digests AS (
    SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256
    FROM centroids5 GROUP BY cluster
)
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance,
       CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
       CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near5 JOIN digests ON best[2] = cluster"""
