"""DuckDB SQL of the corpus queries that SQL can express (own statement of the contract)."""

SQL = {
    "op3_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
               sha256(t.text) AS text_sha256
        FROM t JOIN g USING (text)""",
    "op7_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5('mix-1:' || doc_id::VARCHAR) AS h
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS w,
                     source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total
              FROM s),
        l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                        / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
              FROM w),
        f AS (SELECT *, max(CASE WHEN level * w < cap THEN level END) OVER () AS final FROM l),
        p AS (SELECT source, source_size, CASE WHEN level * w >= cap THEN cap ELSE final * w END AS target,
                     ('0x' || substr(md5('mix-1:offset:' || coalesce(source, '-')), 1, 4))::BIGINT / 65536.0::DOUBLE AS u
              FROM f),
        b AS (SELECT *, floor(sqrt(size::DOUBLE)) AS band,
                     ceil(count(*) OVER (PARTITION BY source, floor(sqrt(size::DOUBLE))) / 20000.0) AS blocks
              FROM d),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY band,
                     floor(('0x' || substr(h, 1, 8))::BIGINT / 4294967296.0::DOUBLE * blocks), size, h, doc_id) - 1 AS rk
              FROM b),
        c AS (SELECT r.doc_id, r.size, p.source_size, p.target, p.u, r.rk,
                     CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0.0 END::DOUBLE AS each
              FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target,
               ((floor((rk + 1) * each + u) - floor(rk * each + u))::BIGINT * size)::BIGINT AS taken,
               (floor((rk + 1) * each + u) - floor(rk * each + u))::BIGINT AS copies
        FROM c""",
    "op2_arc_to_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
        SELECT p.page_id, octet_length(encode(p.html))::BIGINT AS payload_bytes,
               list_aggregate(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(p.h, 1 + 5 * (j // 4)::INT, 5))::BIGINT >> (15 - 5 * (j % 4))::INT) & 31)::INT, 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN p.page_id = f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN p.page_id <> f.first_id THEN f.first_id END AS refers_to,
               '2024-01-01T00:00:00Z' AS date
        FROM p JOIN f USING (html)""",
    "op4_ngram_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (SELECT doc_id, CASE
                  WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
              FROM d),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
        p AS (SELECT a.doc_id AS i, b.doc_id AS j, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
              FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT i, j FROM p WHERE 100 * c >= 90 * (na + nb - c)),
        b AS (SELECT i, j FROM l UNION ALL SELECT j, i FROM l),
        r(i, j) AS (SELECT i, j FROM b UNION SELECT r.i, b.j FROM r JOIN b ON r.j = b.i)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles,
               least(s.doc_id, coalesce(min(r.j), s.doc_id)) AS component_id
        FROM s LEFT JOIN r ON r.i = s.doc_id GROUP BY s.doc_id, s.s""",
    "op5_near_vectors": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
        n AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS m FROM v),
        b AS (SELECT a.vec_id AS i, c.vec_id AS j FROM n a JOIN n c ON a.vec_id <> c.vec_id
              WHERE list_dot_product(a.x, c.x) >= 0.9 * a.m * c.m),
        r(i, j) AS (SELECT i, j FROM b UNION SELECT r.i, b.j FROM r JOIN b ON r.j = b.i),
        g AS (SELECT i, count(*) AS n_links FROM b GROUP BY i),
        m AS (SELECT i, min(j) AS j FROM r GROUP BY i)
        SELECT v.vec_id, coalesce(g.n_links, 0)::BIGINT AS n_links,
               least(v.vec_id, coalesce(m.j, v.vec_id)) AS component_id,
               v.vec_id <= coalesce(m.j, v.vec_id) AS kept
        FROM v LEFT JOIN g ON g.i = v.vec_id LEFT JOIN m ON m.i = v.vec_id""",
}


def _merkle_sql(levels: int = 5, top: int = 3) -> str:
    """The manifest for up to 16**levels leaves a source and 16**top sources."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    byte = "list_reduce(range(8), lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, b))"
    crc = (f"xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), "
           f"lambda a, b: {byte}, 4294967295::BIGINT))")
    parts = [f"""d AS (SELECT *, {leaf('text')} AS leaf, {leaf('low')} AS lowered, {crc} % 5 = 0 AS tampered
        FROM (SELECT *, translate(text, '{upper}', '{upper.lower()}') AS low FROM documents))""",
             """l AS (SELECT doc_id, source, leaf, CASE WHEN tampered THEN lowered ELSE leaf END AS x,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY source) AS c FROM d)""",
             "s0 AS (SELECT source, i, leaf AS h, c FROM l)"]

    def tree(name: str, n: int, by: str) -> None:
        for k in range(n):
            run = f"PARTITION BY {by}, i // 16 ORDER BY i ROWS BETWEEN"
            parts.append(f"""b{name}{k} AS (SELECT {by}, i, c > 1 AS has,
        coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
        coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k})""")
            parts.append(f"""{name}{k + 1} AS (SELECT {by}, i // 16 AS i, CASE WHEN any_value(c) = 1 THEN any_value(h)
        ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (any_value(c) + 15) // 16 AS c
        FROM {name}{k} GROUP BY {by}, i // 16)""")

    tree("s", levels, "source")
    parts.append(f"""t0 AS (SELECT 0 AS one, source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i,
        count(*) OVER () AS c FROM s{levels})""")
    tree("t", top, "one")
    parts.append(f"""x0 AS (SELECT l.*, t0.h AS subroot, t0.i AS g, t{top}.h AS root, '' AS proof
        FROM l JOIN t0 ON l.source IS NOT DISTINCT FROM t0.source CROSS JOIN t{top})""")
    steps = [("s", k, f"p.source IS NOT DISTINCT FROM x.source AND p.i = x.i // {16 ** k}") for k in range(levels)]
    steps += [("t", k, f"p.i = x.g // {16 ** k}") for k in range(top)]
    for n, (name, k, on) in enumerate(steps):
        parts.append(f"""x{n + 1} AS (SELECT x.* REPLACE (CASE WHEN p.has THEN sha256(p.b || x.x || p.a) ELSE x.x END AS x,
        x.proof || CASE WHEN p.has THEN p.b || p.a ELSE '' END AS proof) FROM x{n} x JOIN b{name}{k} p ON {on})""")
    return "WITH " + ",\n".join(parts) + f"""
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x = root AS verified
        FROM x{len(steps)}"""


SQL["op12_merkle_manifest"] = _merkle_sql()
