"""The training-data operators that SQL can express, as SQL over the same tables."""

from __future__ import annotations

_COMPONENTS = """
    bad AS (
        SELECT DISTINCT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) WHERE x IS NULL OR NOT isfinite(x)
    ),
    comp AS MATERIALIZED (
        SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(floor({scale} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS c
        FROM embeddings WHERE embedding IS NOT NULL AND vec_id NOT IN (SELECT vec_id FROM bad){more}
    )"""

_HARD_NEGATIVES = f"""
WITH {_COMPONENTS.format(scale=256, more=" AND label IS NOT NULL")},
    named AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
        FROM embeddings WHERE vec_id IN (SELECT vec_id FROM comp)
    ),
    scores AS MATERIALIZED (
        SELECT s.anchor, s.other, s.score, a.label = o.label AS same
        FROM (
            SELECT a.vec_id AS anchor, o.vec_id AS other, CAST(sum(a.c * o.c) AS BIGINT) AS score
            FROM comp a JOIN comp o ON a.pos = o.pos
            WHERE a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id GROUP BY 1, 2
        ) s JOIN named a ON a.vec_id = s.anchor JOIN named o ON o.vec_id = s.other
    ),
    positives AS (
        SELECT anchor, other, score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
    ),
    ranked AS (
        SELECT p.anchor, p.other AS positive, p.score AS positive_score, n.other AS negative, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS rank
        FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
             AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    )
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank, negative AS negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""


def _vector_codes(rounds: int = 6) -> str:
    steps = [
        f"WITH {_COMPONENTS.format(scale=4096, more='')}",
        "size AS (SELECT max(pos) + 1 AS n FROM comp)",
        "x AS MATERIALIZED (SELECT vec_id, pos // (n // 8) AS part, pos % (n // 8) AS pos, c FROM comp, size)",
        """b0 AS MATERIALIZED (
            SELECT part, entry, pos, c FROM x JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT DISTINCT vec_id FROM x) QUALIFY entry < 16
            ) USING (vec_id)
        )""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
            SELECT vec_id, part, entry, d FROM (
                SELECT x.vec_id, x.part, b.entry, sum((x.c - b.c) * (x.c - b.c)) AS d FROM x JOIN b{r} b ON x.part = b.part AND x.pos = b.pos GROUP BY 1, 2, 3
            ) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1
        )""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (
                SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN (
                    SELECT part, entry, pos, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c
                    FROM (SELECT x.part, a.entry, x.pos, sum(x.c) AS s, count(*) AS n FROM x JOIN a{r} a ON x.vec_id = a.vec_id AND x.part = a.part GROUP BY 1, 2, 3)
                ) m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos
            )""")
    steps.append(f"""coded AS (
        SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
    FROM coded JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id)""")
    return ",\n".join(steps[:-1]) + ",\n" + steps[-1]


# The smallest node reachable from each, over links (a, b) of both directions.
_REACHED = """
    pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT node, node AS root FROM nodes UNION SELECT pairs.b, reached.root FROM reached JOIN pairs ON pairs.a = reached.node AND reached.root < pairs.b),
    parts AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node)"""

_NEAR_VECTORS = f"""
WITH RECURSIVE bad AS (
        SELECT DISTINCT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) WHERE x IS NULL OR NOT isfinite(x)
    ),
    some AS (SELECT DISTINCT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) WHERE x <> 0),
    good AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND vec_id IN (SELECT vec_id FROM some) AND vec_id NOT IN (SELECT vec_id FROM bad)),
    links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
        WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
    nodes AS (SELECT vec_id AS node FROM embeddings), {_REACHED}
SELECT node AS vec_id, (SELECT count(*) FROM pairs WHERE a = node) AS n_links, component_id, node = component_id AS kept FROM parts
""".replace("some AS (", "nonzero AS (").replace("FROM some)", "FROM nonzero)")

_NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
    ),
    placed AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0),
    shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s FROM placed),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
    nodes AS (SELECT doc_id AS node FROM documents), {_REACHED}
SELECT node AS doc_id, coalesce(n, 0) AS n_shingles, component_id FROM parts LEFT JOIN sizes ON doc_id = node
"""

ORACLES: dict[str, str] = {"op1_near_vectors": _NEAR_VECTORS, "op9_ngram_join": _NGRAM_JOIN, "op12_hard_negatives": _HARD_NEGATIVES, "op13_vector_codes": _vector_codes()}
