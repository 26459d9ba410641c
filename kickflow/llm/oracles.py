"""DuckDB SQL for those corpus queries that SQL can express."""

ORACLES = {
    "op3_warc": """
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ),
        firsts AS (
            SELECT *, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
                   min(page_id) OVER (PARTITION BY payload) AS first_id
            FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id
                    THEN first_id END AS refers_to
        FROM firsts
    """,
    # Here ids are unique and tables small enough for the first 32 bits, those of the id.
    "op4_sharding": """
        WITH hashed AS (
            SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes,
                   ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT AS hash
            FROM documents
        ),
        levels AS (
            SELECT doc_id, n_bytes, depth, hash >> (32 - depth) AS prefix, hash
            FROM hashed, (SELECT unnest(range(0, 13)) AS depth)
        ),
        sums AS (
            SELECT *, sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_rows
            FROM levels WINDOW w AS (PARTITION BY depth, prefix)
        )
        SELECT doc_id, n_bytes,
               substr(lpad(bin(hash), 32, '0'), 1, min(depth)) AS shard,
               CAST(arg_min(shard_bytes, depth) AS BIGINT) AS shard_bytes,
               arg_min(shard_rows, depth) AS shard_rows
        FROM sums WHERE shard_bytes <= 16777216
        GROUP BY doc_id, n_bytes, hash
    """,
    "op6_exact_duplicates": r"""
        WITH texts AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY plain) AS keep_id,
               count(*) OVER (PARTITION BY plain) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY plain) AS kept,
               sha256(plain) AS text_sha256
        FROM texts
    """,
    "op9_decontamination": r"""
        WITH item_words AS (
            SELECT item_id,
                   string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' ') AS w
            FROM benchmark WHERE regexp_matches(text, '\S')
        ),
        item_runs AS (
            SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS run
            FROM (
                SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
                FROM item_words
            )
        ),
        items AS (SELECT item_id, count(*) AS n_item FROM item_runs GROUP BY item_id),
        doc_words AS (
            SELECT doc_id,
                   string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' ') AS w
            FROM documents WHERE regexp_matches(text, '\S')
        ),
        doc_runs AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS run
            FROM (
                SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
                FROM doc_words
            )
        ),
        shared AS (
            SELECT doc_id, item_id, count(*) AS n_shared
            FROM doc_runs JOIN item_runs USING (run) GROUP BY doc_id, item_id
        )
        SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
        FROM shared JOIN items USING (item_id)
        WHERE n_shared >= 0.8 * n_item
    """,
}
