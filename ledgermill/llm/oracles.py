"""The queries of this subpackage as DuckDB SQL, where SQL can express them."""

LINE_DEDUP = """
WITH lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM lines
),
repeated AS (
    SELECT line_key, max(doc_id) AS keeper
    FROM keyed
    WHERE length(line_key) >= 20
    GROUP BY line_key
    HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
    SELECT k.doc_id, k.line, k.pos, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS gone
    FROM keyed k LEFT JOIN repeated r ON r.line_key = k.line_key
)
SELECT doc_id,
       count(*) AS n_lines,
       count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked
GROUP BY doc_id
"""

MIX = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle_key,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS nth,
           1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM sized GROUP BY source
),
-- Each step stops every source whose share would pass its limit, until none does.
steps AS (
    SELECT 0 AS step, list(nth) FILTER (WHERE false) AS stopped FROM sources
    UNION ALL
    SELECT step + 1, now
    FROM (
        SELECT s.step, s.stopped,
               (SELECT list(x.nth ORDER BY x.nth) FROM sources x
                WHERE list_contains(coalesce(s.stopped, []), x.nth)
                   OR x.weight * ((SELECT sum(source_size) FROM sources)
                        - coalesce((SELECT sum(3 * y.source_size) FROM sources y WHERE list_contains(coalesce(s.stopped, []), y.nth)), 0))
                      > 3 * x.source_size
                        * (SELECT sum(y.weight) FROM sources y WHERE NOT list_contains(coalesce(s.stopped, []), y.nth))) AS now
        FROM steps s
    )
    WHERE len(coalesce(now, [])) > len(coalesce(stopped, []))
),
final AS (SELECT coalesce(arg_max(stopped, step), []) AS stopped FROM steps),
shares AS (
    SELECT s.*, list_contains(f.stopped, s.nth) AS stops FROM sources s, final f
),
targets AS (
    SELECT *,
           CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE)
                ELSE CAST(weight * (sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (WHERE stops) OVER (), 0)) AS DOUBLE)
                     / CAST(sum(weight) FILTER (WHERE NOT stops) OVER () AS DOUBLE) END AS target
    FROM shares
),
queued AS (
    SELECT d.*, t.nth, t.source_size, t.target,
           sum(d.size) OVER (PARTITION BY t.nth ORDER BY d.shuffle_key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS sent
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
),
copies AS (
    SELECT q.*, turn, CAST(q.source_size * turn + q.sent AS DOUBLE) / q.target AS finish
    FROM queued q, (SELECT unnest([0, 1, 2]) AS turn)
    WHERE q.size > 0
),
mixed AS (
    SELECT doc_id, size,
           sum(size) OVER (ORDER BY finish, nth, shuffle_key, doc_id, turn ROWS UNBOUNDED PRECEDING)
             <= (SELECT sum(source_size) FROM sources) AS fits
    FROM copies
),
taken AS (SELECT doc_id, CAST(sum(size) FILTER (WHERE fits) AS BIGINT) AS taken FROM mixed GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0) AS taken
FROM queued q LEFT JOIN taken t USING (doc_id)
"""



def clustering_sql(rounds: int) -> str:
    """Components in long form; each round is an assignment and a mean of its own."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (
    SELECT vec_id, arg_min(cluster, distance * 16 + cluster) AS cluster, min(distance) AS distance
    FROM (SELECT x.vec_id, c.cluster, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS distance
          FROM parts x JOIN c{r} c USING (dim) GROUP BY x.vec_id, c.cluster)
    GROUP BY vec_id
)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS (
    SELECT c.cluster, c.dim, coalesce(m.v, c.v) AS v
    FROM c{r} c LEFT JOIN (
        SELECT a.cluster, x.dim,
               CAST((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
        FROM parts x JOIN a{r} a USING (vec_id) GROUP BY a.cluster, x.dim
    ) m USING (cluster, dim)
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS whole
    FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
parts AS MATERIALIZED (SELECT vec_id, unnest(whole) AS v, generate_subscripts(whole, 1) AS dim FROM kept),
c0 AS (
    SELECT cluster, unnest(whole) AS v, generate_subscripts(whole, 1) AS dim
    FROM (SELECT whole, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM kept)
    WHERE cluster < 16
),{",".join(steps)},
names AS (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, n.centroid_sha256
FROM a{rounds} a JOIN names n USING (cluster)
"""


COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
occurrences AS (
    SELECT lang, m, array_to_string(words[i : i + m - 1], ' ') AS phrase
    FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS m)
    WHERE i + m - 1 <= len(words)
),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM occurrences GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
    SELECT lang, m, phrase, f AS a, k, string_split(phrase, ' ') AS w
    FROM counts, (SELECT unnest([1, 2, 3, 4]) AS k)
    WHERE m >= 2 AND k < m
),
valued AS (
    SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
           CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.m], ' ')
    JOIN totals t ON t.lang = c.lang
),
chosen AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
-- Every sub-phrase of every candidate, at every place.
inner_phrases AS (
    SELECT lang, f AS longer_f, array_to_string(w[i : i + s - 1], ' ') AS phrase
    FROM (SELECT lang, f, m, string_split(phrase, ' ') AS w FROM counts WHERE m >= 3),
         (SELECT unnest([2, 3, 4]) AS s), (SELECT unnest([1, 2, 3, 4]) AS i)
    WHERE s < m AND i + s - 1 <= m
),
kept AS (
    SELECT * FROM chosen c
    WHERE NOT EXISTS (SELECT 1 FROM inner_phrases p
                      WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.longer_f >= 100 * c.a)
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


ORACLES = {
    "op8_line_dedup": LINE_DEDUP,
    "op9_mix_sources": MIX,
    "op11_phrases": COLLOCATIONS,
    "op12_centroids": clustering_sql(3),
}
