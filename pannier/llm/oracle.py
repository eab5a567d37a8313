"""The registered queries in SQL, where SQL can express them."""

SQL: dict[str, str] = {}

SQL["op2_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vector, c.vector) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

SQL["op9_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS hash_key, md5(COALESCE(text, '')) AS text_key,
        CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight
    FROM d GROUP BY source
), stops AS (
    SELECT *, 3 * source_size AS cap,
        row_number() OVER (ORDER BY 3 * source_size / weight, source ASC NULLS LAST) AS place
    FROM sources
), levels AS (
    SELECT place, weight, cap,
        CAST((SELECT SUM(source_size) FROM stops) - COALESCE((SELECT SUM(b.cap) FROM stops b WHERE b.place < a.place), 0) AS DOUBLE)
            / CAST((SELECT SUM(b.weight) FROM stops b WHERE b.place >= a.place) AS DOUBLE) AS level
    FROM stops a
), chosen AS (
    SELECT level FROM levels WHERE level * weight <= cap ORDER BY place LIMIT 1
), targets AS (
    SELECT source, source_size, LEAST(CAST(cap AS DOUBLE), level * weight) AS target FROM stops, chosen
), placed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
        CAST(floor(t.target) AS BIGINT) // GREATEST(t.source_size, 1) AS epochs,
        COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY hash_key, size, text_key
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    CAST(epochs * size + GREATEST(0, LEAST(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM placed
"""

SQL["op5_license_scan"] = r"""
WITH RECURSIVE templates(license, notice) AS (VALUES
    ('Apache-2.0', 'Licensed under the Apache License, Version 2.0'),
    ('BSD-3-Clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted'),
    ('CC-BY-4.0', 'This work is licensed under a Creative Commons Attribution 4.0 International License'),
    ('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0'),
    ('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3'),
    ('MIT', 'Released under the MIT License'),
    ('MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0'),
    ('Unlicense', 'This is free and unencumbered software released into the public domain')
), template_words AS (
    SELECT license, unnest(regexp_extract_all(lower(notice), '[a-z]+|[0-9]+(?:\.[0-9]+)*')) AS token FROM templates
), template_counts AS (
    SELECT license, token, COUNT(*) AS n FROM template_words
    WHERE token NOT IN ('a', 'an', 'and', 'are', 'by', 'in', 'into', 'is', 'of', 'or', 'that', 'the', 'this', 'to',
        'under', 'use', 'with', 'without')
    GROUP BY ALL
), rarity AS (
    SELECT token, ln(9.0 / (1 + COUNT(*))) + 1 AS idf FROM template_counts GROUP BY token
), template_weights AS (
    SELECT license, token, n * idf / sqrt(SUM(n * idf * n * idf) OVER (PARTITION BY license)) AS part
    FROM template_counts JOIN rarity USING (token)
), files AS (
    SELECT page_id, CASE WHEN contains(address, '/') THEN address ELSE address || '/' END AS path, html
    FROM (SELECT page_id, regexp_replace(regexp_replace(url, '^[A-Za-z]+://', ''), '[?#].*$', '') AS address, html FROM pages)
), said AS (
    SELECT path, unnest(string_split_regex(regexp_replace(
        regexp_replace(html, '(?s)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>', chr(10), 'g'),
        '([.!?])\s+([A-Z])', '\1' || chr(10) || '\2', 'g'), '\n+')) AS statement
    FROM files
), spoken AS (
    SELECT DISTINCT path, list_filter(regexp_extract_all(lower(statement), '[a-z]+|[0-9]+(?:\.[0-9]+)*'),
        lambda w: w NOT IN ('a', 'an', 'and', 'are', 'by', 'in', 'into', 'is', 'of', 'or', 'that', 'the', 'this', 'to',
            'under', 'use', 'with', 'without')) AS words,
        regexp_matches(lower(statement), '(^|[^a-z])mit +(software +)?licen[cs]e([^a-z]|$)|(licen[cs]ed?|under)( +(is|under|the|terms|of))* +mit([^a-z]|$)') AS names_mit
    FROM said
), weighed AS (
    SELECT path, words, names_mit, token, COUNT(*) * COALESCE(ANY_VALUE(idf), ln(9.0) + 1) AS weight
    FROM (SELECT path, words, names_mit, unnest(words) AS token FROM spoken) LEFT JOIN rarity USING (token)
    GROUP BY path, words, names_mit, token
), lengths AS (
    SELECT path, words, names_mit, sqrt(SUM(weight * weight)) AS length FROM weighed GROUP BY path, words, names_mit
), rated AS (
    SELECT path, license, round(SUM(weight * part) / ANY_VALUE(length), 6) AS cosine
    FROM weighed JOIN template_weights USING (token) JOIN lengths USING (path, words, names_mit)
    WHERE license <> 'MIT' OR names_mit  -- "mit" is a word of other languages
    GROUP BY path, words, names_mit, license
), own AS (
    SELECT path, license, cosine FROM rated WHERE cosine >= 0.6
    QUALIFY row_number() OVER (PARTITION BY path ORDER BY cosine DESC, license) = 1
), placed AS (
    SELECT page_id, path,
        CASE WHEN suffix(path, '/') THEN regexp_replace(path, '/+$', '') ELSE regexp_replace(path, '/*[^/]*$', '') END AS directory
    FROM files
), declared AS (
    SELECT directory AS ancestor, license, cosine FROM own JOIN (SELECT DISTINCT path, directory FROM placed) USING (path)
    WHERE suffix(path, '/')
    QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, license) = 1
), above AS (
    SELECT DISTINCT directory, directory AS ancestor, 0 AS up FROM placed WHERE directory IS NOT NULL
    UNION ALL
    SELECT directory, regexp_replace(ancestor, '/?[^/]*$', ''), up + 1 FROM above WHERE contains(ancestor, '/')
), nearest AS (
    SELECT directory, ancestor, license, cosine FROM above JOIN declared USING (ancestor)
    QUALIFY row_number() OVER (PARTITION BY directory ORDER BY up) = 1
)
SELECT page_id, COALESCE(own.license, nearest.license) AS license, COALESCE(own.cosine, nearest.cosine) AS cosine,
    CASE WHEN own.license IS NULL THEN nearest.ancestor END AS inherited_from
FROM placed LEFT JOIN own USING (path) LEFT JOIN nearest USING (directory)
"""


def _codes_sql(rounds: int = 6) -> str:
    """Integer k-means round by round: each round's codebook is a table of its own."""
    steps = ["""
WITH kept AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
        list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS MATERIALIZED (
    SELECT r, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] AS v
    FROM kept, (SELECT unnest(range(8)) AS part)
), book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM pieces WHERE r <= 16"""]
    for k in range(rounds + 1):
        steps.append(f"""
), near{k} AS MATERIALIZED (
    SELECT r, p.part, p.v, arg_min({{'d': d, 'entry': entry}}, (d, entry)) AS best FROM (
        SELECT r, p.part, p.v, entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM pieces p JOIN book{k} b ON p.part = b.part
    ) p GROUP BY r, p.part, p.v""")
        if k < rounds:
            steps.append(f"""
), moved{k} AS (
    SELECT part, entry, list(m ORDER BY place) AS v FROM (
        SELECT part, best.entry AS entry, place, CAST(sum(x) AS HUGEINT) AS s, count(*)::HUGEINT AS n,
            CAST((s - ((s % n + n) % n)) // n AS BIGINT) AS m
        FROM (SELECT part, best, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM near{k}) GROUP BY ALL
    ) GROUP BY part, entry
), book{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, COALESCE(m.v, b.v) AS v FROM book{k} b LEFT JOIN moved{k} m ON b.part = m.part AND b.entry = m.entry""")
    steps.append(f"""
), coded AS (
    SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM near{rounds} GROUP BY r
), books AS (
    SELECT sha256(COALESCE(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry), '')) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
""")
    return "".join(steps)


SQL["op11_vector_codes"] = _codes_sql()

SQL["op12_periodic_runs"] = r"""
WITH RECURSIVE bits(b, k, c) AS (
    SELECT b, 0, b FROM range(256) t(b)
    UNION ALL
    SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8
), hashed AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
            lambda s, x: xor(s >> 8, t[1 + (xor(s, x) & 255)]))) AS h
    FROM documents, crc
), planned AS (
    SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS g8 FROM hashed
), docs AS MATERIALIZED (
    SELECT r, doc_id, n,
        CASE WHEN made THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g8)) END]) ELSE w END AS w
    FROM planned
), words AS MATERIALIZED (
    SELECT r, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs
), grams AS MATERIALIZED (
    SELECT r, n, i, word || ' ' || lead(word, 1) OVER s || ' ' || lead(word, 2) OVER s || ' ' || lead(word, 3) OVER s || ' ' || lead(word, 4) OVER s AS gram
    FROM words WINDOW s AS (PARTITION BY r ORDER BY i)
), diagonal AS (
    SELECT a.r, b.i - a.i AS q, a.i, a.i - row_number() OVER (PARTITION BY a.r, b.i - a.i ORDER BY a.i) AS island
    FROM grams a JOIN grams b ON a.r = b.r AND a.gram = b.gram AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), stretches AS (
    SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM diagonal GROUP BY r, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)
), runs AS MATERIALIZED (
    SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length
), listed AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r
), top AS (
    SELECT * FROM runs x
    WHERE NOT EXISTS (SELECT 1 FROM runs y WHERE y.r = x.r AND (y.length * x.period > x.length * y.period
        OR y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period)))
), dropped AS (
    SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, COALESCE(n_runs, 0) AS n_runs, top.start, top.length, top.period, 1000 * top.length // top.period AS exponent_milli,
    sha256(COALESCE(lines, '')) AS runs_sha256, sha256(COALESCE(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (r) LEFT JOIN top USING (r) LEFT JOIN collapsed USING (r)
"""

SQL["op13_decontamination"] = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS MATERIALIZED (
    SELECT DISTINCT item, size, array_to_string(w[s + 1 : s + size], ' ') AS said
    FROM (SELECT item, w, least(len(w), 10) AS size, unnest(range(len(w) - least(len(w), 10) + 1)) AS s FROM items WHERE len(w) > 0)
), places AS (
    SELECT r, s, size, array_to_string(w[s + 1 : s + size], ' ') AS said
    FROM (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS s FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS MATERIALIZED (
    SELECT r, s, size, said FROM places SEMI JOIN windows USING (size, said)
), covered AS (
    SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + size)) AS i FROM hits) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT r, item FROM hits JOIN windows USING (size, said) WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
    sha256(COALESCE(listed, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
