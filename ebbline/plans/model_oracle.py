"""SQL counterparts of fitted models, level by level."""

from __future__ import annotations

from ebbline.operators.boosting import UNIT, Settings


def boosted_sql(s: Settings, bins: int) -> str:
    """Quantile bins, gradients, best splits and leaves of every round, as common table expressions."""
    shares = ", ".join(str(i / bins) for i in range(1, bins))
    steps = [
        "frame AS (SELECT vec_id AS id, CAST(label = 0 AS INTEGER) AS label, embedding FROM embeddings)",
        "cells AS (SELECT id, i - 1 AS f, CAST(embedding[i] AS DOUBLE) AS v FROM frame, (SELECT unnest(range(1, 65)) AS i))",
        f"edges AS (SELECT DISTINCT f, unnest(quantile_disc(v, [{shares}])) AS e FROM cells GROUP BY f)",
        "binned AS (SELECT c.id, c.f, count(e.e) AS b FROM cells c LEFT JOIN edges e ON e.f = c.f AND e.e < c.v GROUP BY c.id, c.f)",
        "margin0 AS (SELECT id, label, CAST(0 AS DOUBLE) AS m FROM frame)",
    ]

    def score(g: str, h: str) -> str:
        beyond = f"greatest(abs(CAST({g} AS DOUBLE) / {UNIT}) - {s.l1}, 0)"
        below = f"(CAST({h} AS DOUBLE) / {UNIT} + {s.l2})"
        return f"CASE WHEN {below} > 0 THEN {beyond} * {beyond} / {below} ELSE 0 END"

    least = s.least_child * UNIT
    for r in range(1, s.rounds + 1):
        steps.append(
            f"""node{r}_0 AS (SELECT id, label, m, 0 AS node,
            CAST(round((1 / (1 + exp(-m)) - label) * {UNIT}) AS BIGINT) AS g,
            CAST(round(1 / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m))) * {UNIT}) AS BIGINT) AS h FROM margin{r - 1})"""
        )
        for level in range(s.depth):
            k = f"{r}_{level}"
            steps += [
                f"hist{k} AS (SELECT node, f, b, sum(g) AS g, sum(h) AS h FROM node{k} JOIN binned USING (id) GROUP BY node, f, b)",
                f"""cut{k} AS (SELECT node, f, b, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
                sum(g) OVER (PARTITION BY node, f) AS gt, sum(h) OVER (PARTITION BY node, f) AS ht
                FROM hist{k} WINDOW w AS (PARTITION BY node, f ORDER BY b))""",
                f"""gain{k} AS (SELECT node, f, b,
                0.5 * (({score("gl", "hl")}) + ({score("(gt - gl)", "(ht - hl)")}) - ({score("gt", "ht")})) - {s.gamma} AS gain
                FROM cut{k} WHERE least(hl, ht - hl) >= {least} AND least(hl, ht - hl) > 0)""",
                f"""best{k} AS (SELECT * FROM gain{k} WHERE gain > 1e-9
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1)""",
                f"""node{r}_{level + 1} AS (SELECT n.id, label, m, g, h,
                CASE WHEN s.node IS NULL THEN n.node ELSE 2 * n.node + 1 + CAST(x.b > s.b AS INTEGER) END AS node
                FROM node{k} n LEFT JOIN best{k} s ON s.node = n.node LEFT JOIN binned x ON x.id = n.id AND x.f = s.f)""",
            ]
        last = f"node{r}_{s.depth}"
        steps += [
            f"""leaf{r} AS (SELECT node, -{s.rate} * sign(sum(g)) * greatest(abs(CAST(sum(g) AS DOUBLE) / {UNIT}) - {s.l1}, 0)
            / (CAST(sum(h) AS DOUBLE) / {UNIT} + {s.l2}) AS value FROM {last} GROUP BY node)""",
            f"margin{r} AS (SELECT id, label, m + value AS m FROM {last} JOIN leaf{r} USING (node))",
        ]
    stages = ", ".join(f"round(1 / (1 + exp(-m{r}.m)), 6) AS p_{r}" for r in range(1, s.rounds + 1))
    joins = " ".join(f"JOIN margin{r} m{r} USING (id)" for r in range(1, s.rounds + 1))
    return f"WITH {', '.join(steps)} SELECT id, frame.label AS label, {stages} FROM frame {joins}"
