"""DuckDB SQL for the queries that SQL can express."""

TOP_K = """
    WITH v AS (
        SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id))
    WHERE rank <= 5"""

LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LEXICAL = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents WHERE text IS NOT NULL),
    asked AS (
        SELECT query, item_id, term, count(*) AS times FROM (
            SELECT row_number() OVER () AS query, item_id,
                unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark WHERE text IS NOT NULL)
        GROUP BY ALL),
    totals AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
    lengths AS (
        SELECT row, doc_id, 100 - 25 + (25 * len(terms) * n_docs) // n_terms AS m FROM docs, totals WHERE len(terms) > 0),
    postings AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY ALL),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
    scores AS (
        SELECT query, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
            CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
        FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (row)
        GROUP BY query, row)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank
        FROM scores WHERE score > 0)
    WHERE rank <= 20"""

# CRC-32 byte by byte: its table by the usual rule, each text as the list of its UTF-8 bytes.
RESAMPLING = rf"""
    WITH steps AS (
        SELECT n, list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
        FROM range(256) AS t(n)),
    crc_table AS (SELECT list(c ORDER BY n) AS crcs FROM steps),
    texts AS (
        SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents),
    targets AS (SELECT regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
    runs AS (
        SELECT row, unnest(words) AS feature FROM texts
        UNION ALL SELECT row, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM texts
        UNION ALL SELECT row, unnest(list_transform(range(1, len(words) - 1),
            lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) FROM texts),
    target_runs AS (
        SELECT unnest(words) AS feature FROM targets
        UNION ALL SELECT unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM targets
        UNION ALL SELECT unnest(list_transform(range(1, len(words) - 1),
            lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) FROM targets),
    spelled AS (
        SELECT feature, hex(encode(feature)) AS digits
        FROM (SELECT feature FROM runs UNION SELECT feature FROM target_runs)),
    hashed AS (
        SELECT feature, xor(4294967295, list_reduce(
            list_transform(range(0, len(digits) // 2 + 1), lambda i: CASE WHEN i = 0 THEN 4294967295 ELSE
                CAST(16 * (instr('0123456789ABCDEF', digits[2 * i - 1]) - 1) + instr('0123456789ABCDEF', digits[2 * i]) - 1 AS BIGINT) END),
            lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
        FROM spelled, crc_table),
    counted AS (SELECT row, bucket, count(*) AS n FROM runs JOIN hashed USING (feature) GROUP BY ALL),
    s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM counted GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM target_runs JOIN hashed USING (feature) GROUP BY bucket),
    totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS all_s, (SELECT coalesce(sum(t), 0) FROM t) AS all_t),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln(
            (CAST(coalesce(t, 0) AS DOUBLE) + 1) * (all_s + 10000) / ((CAST(s AS DOUBLE) + 1) * (all_t + 10000)))) AS BIGINT) AS gain
        FROM s LEFT JOIN t USING (bucket), totals),
    weighed AS (
        SELECT row, CAST(sum(n * gain) AS BIGINT) AS weight, CAST(sum(n) AS BIGINT) AS n_features
        FROM counted JOIN gains USING (bucket) GROUP BY row),
    scored AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(
                ('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score,
            coalesce(len(words), 0) >= 20 AS able
        FROM texts LEFT JOIN weighed USING (row))
    SELECT doc_id, n_features, weight, score,
        CASE WHEN able AND place <= 5 * (SELECT count(*) FROM scored WHERE able) // 100 THEN place END AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)"""

SQL: dict[str, str] = {"op8_top_k": TOP_K, "op12_lexical": LEXICAL, "op13_resampling": RESAMPLING}
