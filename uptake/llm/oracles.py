"""SQL with the results of the registered queries, where SQL can express them."""

from __future__ import annotations

from uptake.llm.licenses import TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_JOIN = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
        END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(b) AS component_id
FROM sets JOIN reached ON doc_id = a GROUP BY doc_id, s
"""

TOPK = """
WITH usable AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v),
            lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
    FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), firsts AS (
    SELECT payload, max(page_id) AS response FROM payloads GROUP BY payload
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
            ('0x' || substr(digest, 5 * (i // 4) + 1, 5))::BIGINT // (32 ** (3 - i % 4))::BIGINT % 32
            AS INTEGER), 1)
        FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> response THEN response END AS refers_to
FROM payloads JOIN firsts USING (payload)
"""

# The check sum is computed byte by byte; its table of 256 numbers follows from the polynomial.
_CRC_TABLE = """SELECT list_transform(range(256), lambda b: list_reduce([CAST(b AS BIGINT)] || range(8)::BIGINT[],
        lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""
SHARDING = f"""
WITH crc_table AS (
    {_CRC_TABLE}
), sums AS (
    SELECT doc_id, xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(
            range(1, 2 * strlen(coalesce(text, '')) + 1, 2),
            lambda i: CAST(('0x' || substr(hex(coalesce(text, '')), i, 2)) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[1 + xor(c & 255, b)])), 4294967295) AS text_crc32,
        CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size
    FROM documents, crc_table
), scores AS (
    SELECT doc_id, size, text_crc32, s, -ln((CAST('0x' || substr(md5(
        coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || s), 1, 13) AS BIGINT) + 0.5::DOUBLE)
        / 4503599627370496::DOUBLE) AS score
    FROM sums, range(17) r(s)
), placed AS (
    SELECT doc_id, size, text_crc32, arg_min(s, score) FILTER (s < 16) AS shard,
        arg_min(s, score) AS grown_shard
    FROM scores GROUP BY ALL
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
    CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""

_TEMPLATE_ROWS = ", ".join(
    f"('{name}', {i}, '{text}')" for name, own in TEMPLATES.items() for i, text in enumerate(own)
)
LICENSE_SCAN = rf"""
WITH RECURSIVE lines AS (
    SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line,
        unnest(string_split(text, chr(10))) AS text
    FROM documents WHERE text IS NOT NULL
), templates(license, variant, text) AS (VALUES {_TEMPLATE_ROWS}
), units AS (
    SELECT doc_id, line, 0 AS piece, CAST(NULL AS VARCHAR) AS license, CAST(NULL AS INT) AS variant,
        text
    FROM lines
    UNION ALL SELECT doc_id, 0, 0, NULL, NULL, text FROM documents WHERE contains(text, chr(10))
    UNION ALL
    SELECT doc_id, line, unnest(range(1, len(p) + 1)), NULL, NULL, unnest(p) FROM (
        SELECT *, string_split(
            regexp_replace(text, '([.!?;:])[ \t]+', '\1' || chr(1), 'g'), chr(1)) AS p
        FROM lines)
    UNION ALL SELECT NULL, NULL, NULL, license, variant, text FROM templates
), split AS (
    SELECT * EXCLUDE text, list_filter(string_split_regex({_LOWER}, '[\x00-/:-`\{{-\x7F]+'),
        lambda w: w <> '') AS w
    FROM units
), known AS (
    SELECT license, variant, CASE WHEN len(w) = 1 THEN w
        ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s
    FROM split WHERE license IS NOT NULL AND len(w) > 0
), pieces AS (
    SELECT doc_id, line, w, row_number() OVER (PARTITION BY doc_id ORDER BY line, piece) AS piece,
        sum(len(w)) OVER (PARTITION BY doc_id, line) AS total
    FROM split WHERE piece > 0 AND len(w) > 0
), vocabulary AS (
    SELECT DISTINCT unnest(w) AS word FROM split WHERE license IS NOT NULL
), edges AS (
    SELECT p.doc_id, p.piece FROM pieces p WHERE w[1] IN (FROM vocabulary)
        OR w[-1] IN (FROM vocabulary) OR list_has_any([w[i] || ' ' || w[i + 1]
            FOR i IN range(1, len(w))], (SELECT flatten(list(s)) FROM known))
), runs AS (
    SELECT doc_id, piece AS first, piece AS last, line, line AS last_line, total, w
    FROM pieces SEMI JOIN edges USING (doc_id, piece)
    WHERE len(w) <= (SELECT max(floor(len(s) * 1.5)) + 1 FROM known)
    UNION ALL
    SELECT r.doc_id, first, p.piece, r.line, p.line, r.total, r.w || p.w
    FROM runs r JOIN pieces p ON p.doc_id = r.doc_id AND p.piece = r.last + 1
    WHERE len(r.w) + len(p.w) <= (SELECT max(floor(len(s) * 1.5)) + 1 FROM known)
), compared AS (
    SELECT doc_id, first, last, line, last_line, line = last_line AND total = len(w) AS is_line, w
    FROM runs
    UNION ALL SELECT doc_id, NULL, NULL, line, line, false, w
    FROM split WHERE piece = 0 AND len(w) > 0
), sets AS (
    SELECT * EXCLUDE w, len(w) AS n, CASE WHEN len(w) = 1 THEN w
        ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s
    FROM compared
), scored AS (
    SELECT d.* EXCLUDE s, license, variant, len(list_intersect(d.s, t.s)) AS shared,
        len(d.s) + len(t.s) AS together
    FROM sets d JOIN known t
    ON 2 * least(len(d.s), len(t.s)) >= 0.8::DOUBLE * (len(d.s) + len(t.s)) - 1e-6::DOUBLE
), matched AS (
    SELECT *, 2 * shared::DOUBLE / together AS dice FROM scored WHERE 2 * shared >= 0.8::DOUBLE * together
), own_best AS (
    SELECT * FROM matched a WHERE a.first IS NULL OR NOT EXISTS (
        SELECT 1 FROM matched b
        WHERE b.doc_id = a.doc_id AND b.license = a.license AND b.variant = a.variant
            AND b.first <= a.last AND b.last >= a.first
            AND (-b.dice, b.n, b.first, b.last) < (-a.dice, a.n, a.first, a.last))
), best AS (
    SELECT * FROM own_best a WHERE NOT EXISTS (
        SELECT 1 FROM own_best b
        WHERE b.doc_id = a.doc_id
            AND (b.first <= a.last AND b.last >= a.first
                OR b.first IS NULL AND a.first IS NULL AND b.line = a.line)
            AND (-b.dice, b.n, coalesce(b.first, 0), coalesce(b.last, 0), b.license, b.variant)
                < (-a.dice, a.n, coalesce(a.first, 0), coalesce(a.last, 0), a.license, a.variant))
)
SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(last_line AS INTEGER) AS last_line,
    CAST(first AS INTEGER) AS first_piece, CAST(last AS INTEGER) AS last_piece, license, variant,
    CAST(shared AS INTEGER) AS shared, dice
FROM best WHERE NOT is_line
"""

# Escapes of the chat template: one more backslash after the first character of a control string.
_CHAT_TEXT = r"""regexp_replace(regexp_replace(body,
    '(<)(\\*(?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>))', '\1\\\2', 'g'),
    '(\[)(\\*(?:INST\]|/INST\]))', '\1\\\2', 'g')"""
_CHAT_ROLE = r"""replace(replace(replace(replace(who,
    '\', '\\'), chr(10), '\n'), '<', '\l'), '[', '\b')"""
CHAT_FORMAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS who, coalesce(text, '') AS body FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(who || chr(10) || body || chr(10), '' ORDER BY turn NULLS FIRST, who, body) AS turns,
        coalesce(string_agg(body, '' ORDER BY turn NULLS FIRST, who, body)
            FILTER (who = 'assistant'), '') AS learned,
        string_agg('<|im_start|>' || {_CHAT_ROLE} || chr(10) || {_CHAT_TEXT} || '<|im_end|>' || chr(10),
            '') AS formatted
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256,
    CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
    CAST(length(formatted) AS BIGINT) AS formatted_chars
FROM joined
"""

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(
        unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\x0A-\x0D]+')), '[^\x20\x09]+') AS w
    FROM documents
), runs AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM pieces, unnest(range(1, 6)) s(k), unnest(range(1, len(w) - k + 2)) t(i)
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), frequent AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 100
), inside AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS most
    FROM frequent, unnest(range(2, k)) s(m), unnest(range(1, k - m + 2)) t(i) GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, cut, l.f AS l, r.f AS r, n,
        (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
    FROM frequent c, unnest(range(1, c.k)) s(cut)
        JOIN counts l ON c.lang = l.lang AND l.phrase = array_to_string(c.w[:cut], ' ')
        JOIN counts r ON c.lang = r.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
        JOIN totals ON c.lang = totals.lang
    WHERE NOT EXISTS (SELECT 1 FROM inside x
        WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.most >= 100 * c.f)
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000
"""

PREFIX_TRIE = rf"""
WITH crc_table AS (
    {_CRC_TABLE}
), turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who, digest) AS pos,
        [who, body] AS label, len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT *, coalesce(role, '') AS who, coalesce(text, '') AS body,
        sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
    SELECT conv_id, max(pos) AS own, conv_id - conv_id % 20 AS base, xor(list_reduce(
        [CAST(4294967295 AS BIGINT)] || list_transform(
            range(1, 2 * strlen(CAST(conv_id AS VARCHAR)) + 1, 2),
            lambda i: CAST(('0x' || substr(hex(CAST(conv_id AS VARCHAR)), i, 2)) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[1 + xor(c & 255, b)])), 4294967295) % 4 AS h
    FROM turns, crc_table GROUP BY conv_id, t
), lists AS (
    SELECT conv_id, list(label ORDER BY pos) AS labels, list(words ORDER BY pos) AS words
    FROM turns GROUP BY conv_id
), whole AS (
    SELECT c.conv_id, coalesce(b.labels[1:h], []) || o.labels[h + 1:] AS labels,
        coalesce(b.words[1:h], []) || o.words[h + 1:] AS words
    FROM convs c JOIN lists o ON c.conv_id = o.conv_id LEFT JOIN lists b ON c.base = b.conv_id
), prefixes AS (
    SELECT conv_id, d, labels[1:d] AS prefix, labels[1:d - 1] AS above,
        CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words, len(labels) = d AS ends
    FROM whole, unnest(range(len(labels) + 1)) r(d)
), nodes AS (
    SELECT min(conv_id) AS conv_id, d, prefix, any_value(above) AS above, count(*) AS n,
        any_value(words) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), ''))
            AS ends_sha256
    FROM prefixes GROUP BY d, prefix
), children AS (
    SELECT above, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), totals AS (
    SELECT prefix[1:r.d] AS prefix, r.d, count(*) FILTER (n_children IS NULL) AS n_leaves,
        sum((n - 1) * words) AS saved
    FROM nodes LEFT JOIN children ON prefix = children.above AND nodes.d = children.d,
        unnest(range(nodes.d + 1)) r(d)
    GROUP BY ALL
)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, parents.conv_id AS parent_conv_id,
    nodes.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    CAST(saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN totals ON nodes.prefix = totals.prefix AND nodes.d = totals.d
    LEFT JOIN children ON nodes.prefix = children.above AND nodes.d = children.d
    LEFT JOIN nodes parents ON nodes.d > 0 AND nodes.above = parents.prefix AND nodes.d - 1 = parents.d
"""

ORACLES: dict[str, str] = {
    "op2_topk": TOPK,
    "op3_warc": WARC,
    "op4_license_scan": LICENSE_SCAN,
    "op5_sharding": SHARDING,
    "op7_jaccard_join": JACCARD_JOIN,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_collocations": COLLOCATIONS,
    "op13_chat_format": CHAT_FORMAT,
}
