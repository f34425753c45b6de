"""Standard SQL of the queries that SQL can express.

Texts are cut into words by regular expressions, sets compared by joins on their members, groups found by recursion; so
these statements share nothing with the operators but the definition.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LETTERS_WORD = r"[^\x00-/:-@\[-`{-\x7f]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sets(table: str, key: str, text: str, pattern: str) -> str:
    """(key, s): the distinct five-word shingles of each text, or its whole sequence if it has fewer words."""
    return f"""
        SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
              FROM (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS w FROM {table}) WHERE len(w) > 0)"""


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (n[{k // 4 + 1}] // {32 ** (3 - k % 4)}) % 32, 1)" for k in range(32))
_FIVE_DIGITS = ", ".join(
    "(" + " + ".join(f"(strpos('0123456789abcdef', substr(h, {5 * g + d + 1}, 1)) - 1) * {16 ** (4 - d)}" for d in range(5))
    + ")" for g in range(8))

ORACLES: dict[str, str] = {
    "op1_warc": f"""
        WITH payloads AS (SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                                 sha1(coalesce(html, '')) AS h FROM pages),
             numbers AS (SELECT *, [{_FIVE_DIGITS}] AS n FROM payloads),
             digests AS (SELECT *, {_BASE32} AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM numbers)
        SELECT page_id, url, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM digests""",
    "op2_decontamination": f"""
        WITH d AS ({_sets('documents', 'doc_id', 'lower(text)', LETTERS_WORD)}),
             i AS ({_sets('benchmark', 'item_id', 'lower(text)', LETTERS_WORD)}),
             sizes AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
             found AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_shared, n_item, CAST(n_shared AS DOUBLE) / n_item AS containment
        FROM found JOIN sizes USING (item_id) WHERE 100 * n_shared >= 75 * n_item""",
    "op4_source_mix": f"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
                   (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE)
                       / 281474976710656::DOUBLE AS u FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CASE WHEN sum(size) > 0 THEN CAST(sum(size * ((size * 1024) // (size + 256))) AS DOUBLE) / sum(size) END AS mean_length,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source),
        levels AS (
            SELECT 0 AS round, (SELECT CAST(sum(source_size) AS DOUBLE) / sum(weight) FROM sources) AS level
            UNION ALL
            SELECT round + 1, (SELECT CAST(sum(source_size) - coalesce(sum(3 * source_size) FILTER (weight * level > 3 * source_size), 0)
                                           AS DOUBLE) / sum(weight) FILTER (weight * level <= 3 * source_size) FROM sources)
            FROM levels WHERE round < 60),
        targets AS (
            SELECT *, least(3.0::DOUBLE * source_size, weight * (SELECT level FROM levels WHERE round = 60)) AS target FROM sources),
        parts AS (
            SELECT *, floor(target / source_size) AS whole, target / source_size - floor(target / source_size) AS share,
                   target - floor(target / source_size) * source_size AS rest FROM targets),
        chances AS (
            SELECT doc_id, size, u, source_size, target, whole, share, rest, p.source,
                   share + least(share, 1 - share) * ((mean_length - (size * 1024) // (size + 256)) / 1024) AS chance
            FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),
        ranked AS (
            SELECT *, CASE WHEN share > 0 THEN (u / (1 - u)) / (chance / (1 - chance)) END AS q FROM chances),
        placed AS (
            SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q / (1 + q)) AS upto,
                   sum(size) OVER (PARTITION BY source, q) AS own FROM ranked)
        SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE
                   WHEN q IS NULL THEN 0 WHEN upto < rest THEN 1 WHEN upto - own < rest AND upto - rest <= rest - (upto - own) THEN 1
                   ELSE 0 END) AS BIGINT) AS taken
        FROM placed""",
    "op5_minhash_near_dedup": f"""
        WITH RECURSIVE sets AS ({_sets('documents', 'doc_id', f"translate(text, '{UPPER}', '{LOWER}')", WORD)}),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
                 JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 75 * (m.n + n.n - count(*))),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
        least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least_of ON x = d.doc_id""",
    "op6_multiset_fingerprints": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
        following AS (SELECT doc_id, coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id FROM t),
        edits AS (
            SELECT a.doc_id, a.n, next_id, a.text, substr(a.text, 1, a.n - a.n // 2) || substr(b.text, 1, a.n // 2) AS edited
            FROM t a JOIN following f ON a.doc_id = f.doc_id JOIN t b ON b.doc_id = f.next_id),
        texts AS (SELECT doc_id, 0 AS which, text FROM edits UNION ALL SELECT doc_id, 1, edited FROM edits),
        units AS (SELECT doc_id, which, unnest(regexp_extract_all(
                      text, '(?:[^ \t\n]*[^ \t\n.][ \t]+){0,7}[^ \t\n]+')) AS u FROM texts),
        digests AS (SELECT doc_id, which, sha256(u) AS d FROM units),
        blocks AS (SELECT doc_id, which, k, sha256(k || ':' || d) AS h FROM digests, (SELECT unnest(range(6)) AS k)),
        numbers AS (SELECT doc_id, which, k, i, CAST('0x' || substr(h, CAST(1 + 15 * i AS INTEGER), 15) AS BIGINT) AS v
                    FROM blocks, (SELECT unnest(range(4)) AS i)),
        sums AS (SELECT doc_id, which, k * 20 + i * 5 + j AS lane,
                        CAST(sum(2 * ((v >> CAST(12 * j AS INTEGER)) & 4095) - 4095) AS BIGINT) AS s
                 FROM numbers, (SELECT unnest(range(5)) AS j) GROUP BY ALL),
        lanes AS (SELECT t.doc_id, w.which, l.lane, coalesce(s, 0) AS s
                  FROM t, (SELECT unnest(range(2)) AS which) w, (SELECT unnest(range(120)) AS lane) l
                       LEFT JOIN sums ON sums.doc_id = t.doc_id AND sums.which = w.which AND sums.lane = l.lane),
        prints AS (SELECT doc_id, which, string_agg(format('{:08x}', s & 4294967295), '' ORDER BY lane) AS print,
                          CAST(sum(s * s) AS DOUBLE) AS norm FROM lanes GROUP BY ALL),
        dots AS (SELECT e.doc_id, CAST(sum(a.s * b.s) AS DOUBLE) AS to_edited, CAST(sum(a.s * c.s) AS DOUBLE) AS to_next
                 FROM edits e JOIN lanes a ON a.doc_id = e.doc_id AND a.which = 0
                      JOIN lanes b ON b.doc_id = e.doc_id AND b.which = 1 AND b.lane = a.lane
                      JOIN lanes c ON c.doc_id = e.next_id AND c.which = 0 AND c.lane = a.lane
                 GROUP BY e.doc_id)
        SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, a.print AS fingerprint,
               b.print AS edited_fingerprint,
               CASE WHEN a.print = b.print THEN 1 WHEN a.norm * b.norm > 0
                    THEN greatest(0, least(1, to_edited / sqrt(a.norm * b.norm))) ELSE 0 END AS near_edited,
               CASE WHEN a.print = c.print THEN 1 WHEN a.norm * c.norm > 0
                    THEN greatest(0, least(1, to_next / sqrt(a.norm * c.norm))) ELSE 0 END AS near_next
        FROM edits e JOIN dots USING (doc_id) JOIN prints a ON a.doc_id = e.doc_id AND a.which = 0
             JOIN prints b ON b.doc_id = e.doc_id AND b.which = 1 JOIN prints c ON c.doc_id = e.next_id AND c.which = 0""",
    "op12_collocations": rf"""
        WITH texts AS (SELECT row_number() OVER () AS t, coalesce(lang, 'und') AS lang,
                              translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
             pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
             worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
             starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
             sized AS (SELECT lang, w, i, unnest(range(1, 6)) AS k FROM starts),
             counts AS (SELECT lang, w[i:i + k - 1] AS p, k, count(*) AS f FROM sized WHERE i + k - 1 <= len(w) GROUP BY ALL),
             totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
             candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= 100),
             inside AS (SELECT DISTINCT lang, p[j:j + m - 1] AS p, f FROM (
                            SELECT lang, p, k, f, m, unnest(range(1, k - m + 2)) AS j FROM (
                                SELECT *, unnest(range(2, k)) AS m FROM candidates))),
             cuts AS (SELECT *, unnest(range(1, k)) AS c FROM candidates),
             scored AS (SELECT x.lang, x.p, x.f AS a, c, y.f AS l, z.f AS r, n,
                               CAST(1000 * CAST(x.f AS HUGEINT) * n // (CAST(y.f AS HUGEINT) * z.f) AS BIGINT) AS score
                        FROM cuts x JOIN totals USING (lang)
                        JOIN counts y ON y.lang = x.lang AND y.p = x.p[1:c] JOIN counts z ON z.lang = x.lang AND z.p = x.p[c + 1:x.k]),
             weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
               array_to_string(p, ' ') AS phrase, a, l, r, n, score
        FROM weakest x WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = x.lang AND i.p = x.p AND i.f >= x.a)
        QUALIFY rank <= 2000""",
    "op13_hard_negatives": """
        WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                          CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
                   FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
             p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
               score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 10""",
}
