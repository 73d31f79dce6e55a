"""DuckDB SQL for those queries of this package that SQL can express."""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest,
         min(page_id) OVER (PARTITION BY sha256(body)) AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s
QUALIFY rank <= 5
"""

# Words of a text between white space, and of a lower-case text between other ASCII.
_PLAIN = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)

SHINGLES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_PLAIN.format(_LOWER)} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_
    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * both_ >= 80 * (p.n + q.n - both_)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

REPEATS = f"""
WITH d AS (
  SELECT doc_id, {_PLAIN.format("coalesce(text, '')")} AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS seq FROM d, unnest(range(1, len(w) - 18)) t(i)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM later
), lists AS (
  SELECT doc_id, list(place) AS gone FROM gone GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1),
    lambda i: gone IS NULL OR NOT list_contains(gone, i)), lambda i: w[i]), ' ')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)
"""

MIX = f"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key,
    len({_PLAIN.format("coalesce(text, '')")}) AS size
  FROM documents
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY 1
), tried AS (
  SELECT *, 2.0 * source_size / weight AS room, sum(source_size) OVER () AS total,
    coalesce(sum(source_size) OVER before, 0) AS capped,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free
  FROM named WINDOW before AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT 3 * total - 4 * capped AS given, 2 * free AS shares FROM tried
  WHERE (3 * total - 4 * capped) / (2 * free) <= room ORDER BY room, source NULLS LAST LIMIT 1
), plan AS (
  SELECT source, source_size, least((weight * given)::DOUBLE / shares::DOUBLE, 2.0 * source_size)::DOUBLE AS target
  FROM named, level
), cut AS (
  SELECT *, floor(target)::BIGINT // greatest(source_size, 1) AS epochs FROM plan
), placed AS (
  SELECT doc_id, size, source_size, target, epochs, floor(target)::BIGINT - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY d.source, key) AS part,
    sum(size) OVER (PARTITION BY d.source ORDER BY key) AS upto
  FROM d JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
)
SELECT doc_id, size, source_size, target, (epochs * size + CASE WHEN upto <= rest THEN size
  WHEN upto - part <= rest THEN floor(size * (rest - (upto - part)) / part) ELSE 0 END)::BIGINT AS taken
FROM placed
"""

# CRC-32 of a decimal number, eight shifts a character.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
  list_transform(string_split({}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

TRIE = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
  SELECT conv_id, turn, role, sha256(length(role) || ':' || role || text) AS digest,
    len({_PLAIN.format("text")}) AS words
  FROM given
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS pos FROM hashed
), convs AS (
  SELECT conv_id, {_CRC.format("conv_id")} % 4 AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM own)
), joined AS (
  SELECT c.conv_id, 0 AS side, pos, digest, words FROM convs c JOIN own o ON o.conv_id = c.base AND pos <= h
  UNION ALL SELECT conv_id, 1, pos, digest, words FROM convs JOIN own USING (conv_id) WHERE pos > h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, pos) AS depth, digest, words FROM joined
), prefixes AS (
  SELECT conv_id, depth, words, string_agg(digest, ' ') OVER (PARTITION BY conv_id ORDER BY depth
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), ended AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes
), nodes AS (
  SELECT min(conv_id) AS conv_id, depth, key, count(*) AS n_convs, max(words) AS words,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ended
  FROM ended GROUP BY depth, key
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.key AS parent_key FROM nodes n LEFT JOIN nodes p
  ON p.depth = n.depth - 1 AND p.key = CASE WHEN n.depth = 1 THEN '' ELSE left(n.key, 65 * (n.depth - 1) - 1) END
), kids AS (
  SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2
), sized AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN kids USING (depth, key)
), below AS (
  SELECT p.depth, p.key, sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens,
    count(*) FILTER (u.n_children = 0) AS n_leaves
  FROM prefixes p JOIN sized u ON u.conv_id = p.conv_id AND u.depth >= p.depth GROUP BY 1, 2
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
  sha256(coalesce(ended, '')) AS ends_sha256
FROM sized JOIN below USING (depth, key)
"""

RANKED = f"""
WITH d AS (
  SELECT doc_id, {_TERMS} AS w FROM documents
), whole AS (
  SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), tf AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY 1, 2
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY 1
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY 1, 2
), scored AS (
  SELECT item_id, doc_id, sum(times * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN df USING (term) JOIN tf USING (term), whole GROUP BY 1, 2
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

CONTAMINATED = f"""
WITH d AS (
  SELECT doc_id, {_TERMS} AS w FROM documents
), i AS (
  SELECT item_id, {_TERMS} AS w FROM benchmark
), asked AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[j:j + least(10, len(w)) - 1], ' ') AS seq
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(j) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT size FROM asked
), given AS (
  SELECT doc_id, size, j, array_to_string(w[j:j + size - 1], ' ') AS seq
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) t(j)
), hits AS (
  SELECT doc_id, item_id, j, size FROM given JOIN asked USING (size, seq)
), words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + size)) AS place FROM hits) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY 1
), places AS (
  SELECT doc_id, term, list(place) AS places_
  FROM (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS place FROM d) GROUP BY 1, 2
), totals AS (
  SELECT term, sum(len(places_)) AS total FROM places GROUP BY 1
), parts AS (
  SELECT DISTINCT item_id, seq, unnest(string_split(seq, ' ')) AS term FROM asked
), rare AS (
  SELECT item_id, seq, arg_min(term, (total, list_position(string_split(seq, ' '), term))) AS rare, count(*) AS n_terms
  FROM parts JOIN totals USING (term) GROUP BY 1, 2
  HAVING count(*) = len(list_distinct(string_split(seq, ' ')))
), centres AS (
  SELECT r.item_id, r.seq, r.n_terms, p.doc_id, unnest(p.places_) AS centre FROM rare r JOIN places p ON p.term = r.rare
), around AS (
  SELECT c.doc_id, c.item_id, c.seq, c.centre FROM centres c JOIN parts USING (item_id, seq)
  JOIN places p ON p.doc_id = c.doc_id AND p.term = parts.term
  WHERE len(list_filter(p.places_, lambda x: abs(x - c.centre) <= 20)) > 0
  GROUP BY ALL HAVING count(*) = any_value(c.n_terms)
), near AS (
  SELECT doc_id, count(*) AS n_near FROM (SELECT DISTINCT doc_id, item_id FROM around
    EXCEPT SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": TOP_K,
        "op5_ngram_jaccard": SHINGLES,
        "op7_substring_dedup": REPEATS,
        "op9_mixing": MIX,
        "op10_warc": WARC,
        "op11_prefix_trie": TRIE,
        "op12_ranked_search": RANKED,
        "op13_decontamination": CONTAMINATED,
    }
