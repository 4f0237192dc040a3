"""The queries that SQL can express, in SQL."""

from __future__ import annotations

from .rules import BOILERPLATE, NAVIGATION, SYMBOLS

SPACES = r"[\x20\x09-\x0D]+"
WORDS = "list_filter(regexp_split_to_array({}, '" + SPACES + "'), lambda x: x <> '')"
#: Smallest node reachable, from a table ``links`` (a, b) with both directions and a table ``nodes`` (id).
COMPONENTS = """
    reach AS (
        SELECT id AS a, id AS b FROM nodes
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ),
    comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

EMBEDDINGS = f"""
    WITH RECURSIVE good AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
          AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q
          ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.95
    ),
    nodes AS (SELECT vec_id AS id FROM embeddings),
    {COMPONENTS},
    deg AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
    FROM embeddings e JOIN comp c ON e.vec_id = c.id LEFT JOIN deg d ON e.vec_id = d.id
"""

JACCARD = f"""
    WITH RECURSIVE split AS (
        SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
        FROM documents
    ),
    places AS (
        SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0
    ),
    sets AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle FROM places),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (
        SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM sets p JOIN sets q
          ON p.shingle = q.shingle AND p.doc_id <> q.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM common c JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
        WHERE 100 * c.n >= 80 * (s.n + t.n - c.n)
    ),
    nodes AS (SELECT doc_id AS id FROM documents),
    {COMPONENTS}
    SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id
    FROM documents d JOIN comp c ON d.doc_id = c.id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

ARCHIVE = """
    WITH records AS (
        SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h,
               octet_length(encode(coalesce(html, '')))::BIGINT AS size, chr(13) || chr(10) AS nl,
        FROM pages
    ),
    largest AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS response FROM records),
    named AS (
        SELECT *, page_id = response AS whole, lpad(lower(to_hex(page_id)), 16, '0') AS own, lpad(lower(to_hex(response)), 16, '0') AS other,
               array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          ((('0x' || substr(h, i * 5 + 1, 5))::INTEGER >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
               'HTTP/1.1 200 OK' || nl || 'Content-Type: text/html; charset=utf-8' || nl || 'Content-Length: ' || size || nl || nl AS head
        FROM largest
    )
    SELECT page_id, size AS payload_bytes, payload_digest,
           CASE WHEN whole THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN NOT whole THEN response END AS refers_to,
           sha256('WARC/1.1' || nl || 'WARC-Type: ' || CASE WHEN whole THEN 'response' ELSE 'revisit' END
               || nl || 'WARC-Record-ID: <urn:uuid:00000000-0000-8000-' || own[1:4] || '-' || own[5:] || '>'
               || nl || 'WARC-Date: 1970-01-01T00:00:00Z'
               || coalesce(nl || 'WARC-Target-URI: ' || replace(replace(url, chr(13), '%0D'), chr(10), '%0A'), '')
               || nl || 'WARC-Payload-Digest: sha1:' || payload_digest
               || CASE WHEN whole THEN nl || 'Content-Type: application/http; msgtype=response'
                      || nl || 'Content-Length: ' || (octet_length(encode(head)) + size) || nl || nl || head || body
                  ELSE nl || 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest'
                      || nl || 'WARC-Refers-To: <urn:uuid:00000000-0000-8000-' || other[1:4] || '-' || other[5:] || '>'
                      || nl || 'Content-Length: 0' || nl || nl END
               || nl || nl) AS record_sha256
    FROM named
"""


def _symbols(text: str) -> str:
    return f"(length({text}) - length(translate({text}, '{SYMBOLS}', '')))"


RULES = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    split AS (SELECT doc_id, text, {WORDS.format("text")} AS w FROM texts),
    places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) > 2),
    windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places),
    repeated AS (
        SELECT doc_id, count(DISTINCT i + j) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS j) WHERE n > 1 GROUP BY doc_id
    ),
    cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
    lines AS (SELECT doc_id, line, {WORDS.format("line")} AS w FROM cut),
    full_lines AS (SELECT doc_id, line, len(w) AS n, length(array_to_string(w, '')) AS bare FROM lines WHERE len(w) > 0),
    judged AS (
        SELECT *, 10 * {_symbols("line")} <= bare
            AND (n >= 3 OR regexp_matches(line, '[.!?…:;。！？]["''”’»)\\]]*\\s*$'))
            AND NOT (n <= 6 AND regexp_matches(lower(line), '^\\W*({"|".join(NAVIGATION)})\\b'))
            AND NOT regexp_matches(line, '[|»›].*[|»›].*[|»›]')
            AND NOT (n <= 20 AND regexp_matches(lower(line), '{BOILERPLATE}')) AS passes
        FROM full_lines
    ),
    per_doc AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN passes THEN bare ELSE 0 END) AS stays
        FROM judged GROUP BY doc_id
    ),
    base AS (
        SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               {_symbols("text")}::BIGINT AS n_symbols, coalesce(p.dup, 0)::BIGINT AS n_dup_lines,
               coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(p.stays, 0) AS stays
        FROM split s LEFT JOIN repeated r ON r.doc_id = s.doc_id LEFT JOIN per_doc p ON p.doc_id = s.doc_id
    ),
    failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND stays >= 0.5 * word_chars AS kept
    FROM failed
"""

MIXING = r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
    ),
    totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (
        SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight FROM totals
    ),
    levels AS (
        SELECT *, (1.5 * sum(source_size) OVER () - 2 * (sum(source_size) OVER up - source_size))::DOUBLE
                  / (sum(weight) OVER () - sum(weight) OVER up + weight)::DOUBLE AS level
        FROM weighed WINDOW up AS (ORDER BY source_size / weight, source NULLS LAST)
    ),
    shared AS (SELECT max(level) AS level FROM levels),
    targets AS (
        SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * level)::DOUBLE AS target FROM weighed, shared
    ),
    places AS (
        SELECT doc_id, source, size,
               sum(size) OVER (PARTITION BY source ORDER BY md5('0:' || doc_id), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS p,
               sum(size) OVER (PARTITION BY source ORDER BY md5('1:' || doc_id), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS q
        FROM sized
    ),
    quotas AS (
        SELECT doc_id, size, t.source_size, target, p, q + t.source_size AS q, floor(target + 0.5) AS quota
        FROM places JOIN targets t ON places.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
           (greatest(0, least(p + size, quota) - p) + greatest(0, least(q + size, quota) - q))::BIGINT AS taken
    FROM quotas
"""

NEGATIVES = """
    WITH good AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
          AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
        FROM good a JOIN good b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    ),
    positives AS (
        SELECT * FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
    )
    SELECT p.anchor_id, p.other AS positive_id,
           (row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other))::INTEGER AS rank,
           n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    QUALIFY rank <= 3
"""

TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""
    WITH terms AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM terms GROUP BY ALL),
    lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
    totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, totals),
    wanted AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
    scores AS (
        SELECT item_id, doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // totals.terms))))::BIGINT AS score
        FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id
    )
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

LLM_ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": EMBEDDINGS,
    "op6_warc": ARCHIVE,
    "op7_ngram_jaccard": JACCARD,
    "op10_quality_rules": RULES,
    "op11_source_mixing": MIXING,
    "op12_hard_negatives": NEGATIVES,
    "op13_lexical_search": LEXICAL,
}
