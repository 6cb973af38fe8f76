"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

PREFERENCE = """
WITH turns AS (
    SELECT conv_id AS pair_id, turn, min({'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}) AS said
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL
), last AS (
    SELECT pair_id, max(turn) AS last FROM turns WHERE said.role = 'assistant' GROUP BY ALL
), chosen AS (
    SELECT pair_id, turn, said, turn = last AS final FROM turns JOIN last USING (pair_id) WHERE turn <= last
), rejected AS (
    SELECT pair_id, turn, said FROM chosen WHERE NOT final
    UNION ALL
    SELECT c.pair_id, c.turn, other.said
    FROM chosen c JOIN chosen other ON other.final AND other.pair_id = xor(c.pair_id, 1) WHERE c.final
), both_sides AS (
    SELECT pair_id, turn, c.said AS a, r.said AS b FROM chosen c FULL JOIN rejected r USING (pair_id, turn)
), parting AS (
    SELECT pair_id, min(turn) AS parting FROM both_sides WHERE a IS DISTINCT FROM b GROUP BY ALL
), segments AS (
    SELECT pair_id, 'prompt' AS part, turn, a AS said FROM both_sides LEFT JOIN parting USING (pair_id)
    WHERE parting IS NULL OR turn < parting
    UNION ALL
    SELECT pair_id, 'chosen', turn, a FROM both_sides JOIN parting USING (pair_id) WHERE turn >= parting AND a IS NOT NULL
    UNION ALL
    SELECT pair_id, 'rejected', turn, b FROM both_sides JOIN parting USING (pair_id) WHERE turn >= parting AND b IS NOT NULL
)
SELECT pair_id, part, turn, said.role AS role,
       '<|' || said.role || '|>' || chr(10) || said.text || '<|end|>' || chr(10) AS rendered,
       CAST(CASE WHEN part <> 'prompt' AND said.role = 'assistant' THEN length(said.role) + 5 ELSE 0 END AS INTEGER)
           AS loss_start,
       CAST(CASE WHEN part <> 'prompt' AND said.role = 'assistant' THEN length(said.role) + 5 + length(said.text) + 8
            ELSE 0 END AS INTEGER) AS loss_end
FROM segments
"""

PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), spoken AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spoken
), grams AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS g, k
    FROM (SELECT *, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM placed)
), counts AS MATERIALIZED (
    SELECT lang, g, k, count(*) AS n FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(n) AS n FROM counts WHERE k = 1 GROUP BY ALL
), candidates AS MATERIALIZED (
    SELECT lang, g, k AS len, string_split(g, ' ') AS w, n AS a FROM counts WHERE k > 1 AND n >= 100
), parts AS MATERIALIZED (
    SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:len], ' ') AS tail
    FROM (SELECT *, unnest(range(1, len)) AS k FROM candidates)
), cuts AS (
    SELECT p.lang, p.g, p.a, p.k, l.n AS l, r.n AS r, t.n::HUGEINT AS n,
           (1000::HUGEINT * p.a * t.n::HUGEINT) // (l.n::HUGEINT * r.n) AS score
    FROM parts p
    JOIN counts l ON l.lang = p.lang AND l.g = p.head
    JOIN counts r ON r.lang = p.lang AND r.g = p.tail
    JOIN totals t ON t.lang = p.lang
), weakest AS (
    SELECT lang, g, min({'score': score, 'k': k, 'a': a, 'l': l, 'r': r, 'n': n}) AS c FROM cuts GROUP BY ALL
), inside AS (
    SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS g, max(a) AS longer
    FROM (SELECT *, unnest(range(1, len - m + 2)) AS s FROM (SELECT *, unnest(range(2, len)) AS m FROM candidates))
    GROUP BY ALL
), kept AS (
    SELECT lang, g AS phrase, c
    FROM weakest LEFT JOIN inside USING (lang, g) WHERE longer IS NULL OR longer * 100 < c.a * 100
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY c.score DESC, c.a DESC, phrase) AS rank, phrase, c FROM kept
)
SELECT lang, rank, phrase, c.a::BIGINT AS a, c.l::BIGINT AS l, c.r::BIGINT AS r, c.n::BIGINT AS n, c.score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op6_preference_pairs": PREFERENCE, "op11_collocations": PHRASES}
