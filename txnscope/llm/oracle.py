"""DuckDB statements for the text queries that SQL can express."""

OP6 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT rid, doc_id, t,
        list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM d
), g AS (
    SELECT rid, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g,
        unnest(range(1, len(ws) - 3)) AS i
    FROM w
), c AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g
), r AS (
    SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM c WHERE c > 1
), s AS (
    SELECT rid, CAST(sum(CASE WHEN nx IS NULL THEN 5 ELSE least(5, nx - i) END) AS BIGINT) AS n FROM r GROUP BY rid
), m AS (
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        coalesce(s.n, 0) AS n_repeat_words,
        CAST(length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS BIGINT) AS n_capitals
    FROM w LEFT JOIN s USING (rid)
), b AS (
    SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
        + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
        + 16 * (word_chars < 3 * n_words OR word_chars > 10 * n_words)::INT
        + 32 * (100 * n_capitals > 30 * word_chars)::INT AS BIGINT) AS fail_bits
    FROM m
)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
"""


def _floored(total: str, count: str) -> str:
    """Integer division that rounds down."""
    return f"CAST(({total} - (({total} % {count}) + {count}) % {count}) // {count} AS BIGINT)"


def _distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _finite(v: str) -> str:
    return f"{v} IS NOT NULL AND len(list_filter({v}, lambda e: e IS NULL OR NOT isfinite(e))) = 0"


def _op11(rounds: int) -> str:
    """Centroids of one round after another, then the last assignment."""
    steps = [
        f"""v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id,
        list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = 64 AND {_finite('embedding')}
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS c, x
    FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT 16)
)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
    SELECT rid, vec_id, x, c, d FROM (
        SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS n
        FROM (SELECT rid, vec_id, v.x, c, CAST({_distance('v.x', f'c{k}.x')} AS BIGINT) AS d FROM v, c{k})
    ) WHERE n = 1
)""")
        if k < rounds:
            steps.append(f"""m{k} AS (
    SELECT c, list(m ORDER BY i) AS x FROM (
        SELECT c, i, {_floored('sum(e)', 'count(*)')} AS m
        FROM (SELECT c, unnest(range(1, 65)) AS i, unnest(x) AS e FROM a{k}) GROUP BY c, i
    ) GROUP BY c
), c{k + 1} AS MATERIALIZED (
    SELECT c, coalesce(m{k}.x, c{k}.x) AS x FROM c{k} LEFT JOIN m{k} USING (c)
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, a.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} k ON k.c = a.c
"""


OP12 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
    FROM benchmark
), s AS (
    SELECT item, least(len(ws), 10) AS n, ws FROM b WHERE len(ws) > 0
), p AS (
    SELECT DISTINCT item, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS w
    FROM s
), g AS (
    SELECT rid, n, unnest(range(1, len(ws) - n + 2)) AS i,
        unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS w
    FROM d, (SELECT DISTINCT n FROM p) WHERE len(ws) >= n
), f AS (
    SELECT rid, i, n, item FROM g JOIN p USING (n, w)
), h AS (
    SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM f) GROUP BY rid
), t AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item FROM f WHERE item IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""


def _op13(rounds: int) -> str:
    """Codebooks of one round after another, then the last assignment."""
    steps = [
        f"""v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, label,
        list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE {_finite('embedding')} AND len(embedding) > 0 AND len(embedding) % 16 = 0
), k AS MATERIALIZED (
    SELECT *, len(x) // 16 AS w FROM v WHERE len(x) = (SELECT len(x) FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
), p AS MATERIALIZED (
    SELECT rid, i, x[i * w + 1:(i + 1) * w] AS x FROM k, range(16) AS r(i)
), b0 AS MATERIALIZED (
    SELECT i, e, p.x FROM p JOIN (
        SELECT rid, row_number() OVER (ORDER BY vec_id, x) - 1 AS e FROM k WHERE vec_id IS NOT NULL ORDER BY e LIMIT 64
    ) USING (rid)
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT rid, i, x, e, d FROM (
        SELECT *, row_number() OVER (PARTITION BY rid, i ORDER BY d, e) AS n
        FROM (SELECT rid, p.i, p.x, e, CAST({_distance('p.x', f'b{r}.x')} AS BIGINT) AS d FROM p JOIN b{r} USING (i))
    ) WHERE n = 1
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
    SELECT i, e, list(m ORDER BY j) AS x FROM (
        SELECT i, e, j, {_floored('sum(c)', 'count(*)')} AS m
        FROM (SELECT i, e, unnest(range(1, len(x) + 1)) AS j, unnest(x) AS c FROM a{r}) GROUP BY i, e, j
    ) GROUP BY i, e
), b{r + 1} AS MATERIALIZED (
    SELECT i, e, coalesce(m{r}.x, b{r}.x) AS x FROM b{r} LEFT JOIN m{r} USING (i, e)
)""")
    return "WITH " + ", ".join(steps) + f""", c AS (
    SELECT rid, string_agg(lower(printf('%02x', e)), '' ORDER BY i) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY i, e)) FROM b{rounds}) AS codebooks_sha256
FROM k JOIN c USING (rid)
"""


ORACLE: dict[str, str] = {
    "op6_quality_rules": OP6,
    "op11_centroids": _op11(3),
    "op12_decontamination": OP12,
    "op13_vector_codes": _op13(2),
}
