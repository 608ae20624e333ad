"""DuckDB SQL for the operators on integer vectors."""

from __future__ import annotations

_WHOLE = "embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"


def _scaled(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


def codes_sql(scale: int, parts: int, entries: int, rounds: int) -> str:
    """Lloyd rounds over parts, each round two tables; vectors must have one length that ``parts`` divides."""
    far = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"

    def near(n: int) -> str:
        return f"""
    near{n} AS MATERIALIZED (
      SELECT vec_id, part, any_value(x) AS x, min(far) AS far, arg_min(entry, far * {entries} + entry) AS entry
      FROM (SELECT vec_id, part, x, entry, {far} AS far FROM parts JOIN book{n} USING (part)) GROUP BY vec_id, part)"""

    steps = []
    for n in range(rounds):
        steps.append(f"""{near(n)},
    sums{n} AS (
      SELECT part, entry, pos, sum(x[pos]) AS s, count(*) AS n
      FROM near{n}, range(1, {{width}} + 1) t(pos) GROUP BY part, entry, pos),
    book{n + 1} AS MATERIALIZED (
      SELECT part, entry, coalesce(new, c) AS c FROM book{n} LEFT JOIN (
        SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS new FROM sums{n} GROUP BY part, entry)
      USING (part, entry))""".replace("{width}", f"(SELECT any_value(len(v)) // {parts} FROM kept)"))
    return f"""
    WITH kept AS MATERIALIZED (SELECT vec_id, label, {_scaled(scale)} AS v FROM embeddings WHERE {_WHOLE}),
    parts AS MATERIALIZED (
      SELECT vec_id, label, CAST(p AS INT) AS part, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
      FROM kept, range({parts}) t(p)),
    book0 AS MATERIALIZED (
      SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c
      FROM parts QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {entries}),
    {",".join(steps)},{near(rounds)},
    coded AS (
      SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
      FROM near{rounds} GROUP BY vec_id),
    digest AS (
      SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest"""


def negatives_sql(scale: int, every: int, positives: int, negatives: int, low: int, high: int) -> str:
    """All anchors against all rows, by plain integer products."""
    return f"""
    WITH rows AS MATERIALIZED (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_scaled(scale)} AS v
      FROM embeddings WHERE label IS NOT NULL AND {_WHOLE}),
    scores AS MATERIALIZED (
      SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda t: t[1] * t[2])) AS BIGINT) AS score
      FROM rows a JOIN rows b ON a.vec_id % {every} = 0 AND a.vec_id <> b.vec_id),
    tops AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
    SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM tops JOIN scores USING (anchor_id)
    WHERE NOT same AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= {negatives}"""
