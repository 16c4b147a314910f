"""Nearest neighbours by randomly rotated one-bit codes.

A vector is coded relative to the nearest of a few centroids: the signs of its rotated residual,
packed to bits, and three correction scalars - the residual's length, its product with the
centroid, and the agreement of code and residual.  From these a product with any query is
estimated without bias, with an error bound.  A query reranks exactly the vectors whose estimate
plus bound reaches its threshold, the k-th best score within a bounded sample, which can't exceed
the k-th best over all rows.

Rows are dealt by centroid and hash into blocks of about ``BLOCK`` rows, queries into chunks of
``CHUNK``; each task holds one of either, so copies of one vector spread over as many tasks as they
fill.  Every query meets every block (a stated query set against all rows).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import written

SEED = 7
CENTROIDS = 16
#: Rows that centroids and thresholds are fitted on, at most; every row is indexed and searched.
SAMPLE = 8_192
BLOCK, CHUNK = 4_096, 1_024
#: Standard deviations that the error bound allows for.
SIGMAS = 3.0
CODE = "vec_id bigint, vector array<float>, cell int, code binary, length double, offset double, agreement double"


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, n: int = CENTROIDS, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from spread-out rows."""
    n = min(n, len(sample))
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < n:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    centre = sample[chosen].copy()
    for _ in range(rounds):
        near = nearest(sample, centre)
        for k in range(n):
            if (near == k).any():
                centre[k] = sample[near == k].mean(0)
    return centre


def nearest(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((centre**2).sum(1) - 2 * rows @ centre.T).argmin(1)


def encode(rows: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> dict[str, np.ndarray]:
    """Cell, packed signs and correction scalars of float64 rows."""
    cell = nearest(rows, centre)
    residual = rows - centre[cell]
    length = np.sqrt((residual**2).sum(1))
    turned = residual @ turn
    agreement = np.abs(turned).sum(1) / np.sqrt(rows.shape[1]) / np.where(length > 0, length, 1)
    return {
        "cell": cell, "code": np.packbits(turned > 0, axis=1), "length": length,
        "offset": (residual * centre[cell]).sum(1), "agreement": np.where(length > 0, agreement, 1.0),
    }


def estimate(queries: np.ndarray, code: dict[str, np.ndarray], centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated products of queries with the coded rows of one centroid, and their error bounds."""
    dim = queries.shape[1]
    away = queries - centre
    signs = np.unpackbits(code["code"], axis=1)[:, :dim].astype(np.float32) * 2 - 1
    agree = (away @ turn).astype(np.float32) @ signs.T / np.sqrt(dim)
    scale = code["length"] / code["agreement"]
    spread = code["length"] * np.sqrt(np.maximum(0, 1 - code["agreement"] ** 2)) / code["agreement"] / np.sqrt(max(1, dim - 1))
    mean = (queries @ centre)[:, None] + code["offset"][None] + agree * scale[None]
    bound = SIGMAS * np.sqrt((away**2).sum(1))[:, None] * spread[None]
    return mean, bound + 1e-5 * (1 + np.abs(mean))  # the last part is for single precision


def best(queries: pd.DataFrame, rows: pd.DataFrame, centre: np.ndarray, turn: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` best among the rows of one block, of those whose bound reaches the threshold."""
    q, v = np.stack(queries["vector"]).astype(np.float64), np.stack(rows["vector"]).astype(np.float64)
    code = {c: rows[c].to_numpy() for c in ("length", "offset", "agreement")}
    code["code"] = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
    mean, bound = estimate(q, code, centre, turn)
    ids, own, least = rows["vec_id"].to_numpy(), queries["query_id"].to_numpy(), queries["least"].to_numpy()
    out = []
    for i in range(len(q)):
        at = np.flatnonzero((mean[i] + bound[i] >= least[i]) & (ids != own[i]))
        score = np.cumsum(v[at] * q[i], axis=1)[:, -1]  # added up from the left, as a plain loop does
        at, score = at[score >= least[i]], score[score >= least[i]]
        order = np.lexsort((ids[at], -score))[:k]
        out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[at[order]], "score": score[order]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def usable(table: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part: the commonest dimension, finite, not zero."""
    vector = F.col("embedding").cast("array<float>")
    known = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    sizes = known.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return known.where(F.size("vector") == (sizes["n"] if sizes else 0)).dropDuplicates(["vec_id", "vector"])


def search(table: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product for each query.

    Queries are the rows whose vec_id is divisible by ``every``.  Rows with a null id, a null or
    zero vector, null or non-finite components or another dimension than most take no part; rows
    that repeat id and vector are one.  Ties go to the smaller vec_id; a query with fewer
    candidates gets all of them.  Other columns are ignored; an empty table gives no rows.
    """
    spark = table.sparkSession
    rows = written(usable(table))
    count = rows.count()
    if not count:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    share = min(1.0, 0.95 * SAMPLE / count)
    some = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1_000_003)) < share * 1_000_003).toPandas()
    if some.empty:
        some = rows.limit(1).toPandas()
    sample, sample_ids = np.stack(some["vector"]).astype(np.float64), some["vec_id"].to_numpy()
    centre, turn = centroids(sample), rotation(sample.shape[1])

    def code(batches):
        for batch in batches:
            found = encode(np.stack(batch["vector"]).astype(np.float64), centre, turn)
            found["code"] = [c.tobytes() for c in found["code"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "vector": batch["vector"], **found})

    def threshold(batches):
        for batch in batches:
            scores = np.stack(batch["vector"]).astype(np.float64) @ sample.T
            scores[batch["vec_id"].to_numpy()[:, None] == sample_ids] = -np.inf
            few = scores.shape[1] < k
            least = np.full(len(batch), -np.inf) if few else np.partition(scores, -k, axis=1)[:, -k]
            slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
            yield pd.DataFrame({"query_id": batch["vec_id"], "vector": batch["vector"], "least": least - slack})

    coded = written(rows.mapInPandas(code, CODE))
    cells = {r["cell"]: -(-r["count"] // BLOCK) for r in coded.groupBy("cell").count().collect()}
    asked = written(rows.where(F.col("vec_id") % every == 0).mapInPandas(threshold, "query_id bigint, vector array<float>, least double"))
    chunks = max(1, -(-asked.count() // CHUNK))
    blocks = [(c, p) for c, n in sorted(cells.items()) for p in range(n)]
    parts = F.element_at(F.create_map(*[F.lit(x) for pair in cells.items() for x in pair]), F.col("cell"))
    dealt = coded.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    every_block = F.explode(F.array(*[F.struct(F.lit(c).alias("cell"), F.lit(p).alias("part")) for c, p in blocks]))
    sent = asked.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int")).withColumn("_b", every_block).select(
        "query_id", "vector", "least", "chunk", "_b.*"
    )

    def meet(key, queries, block):
        if queries.empty or block.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best(queries, block, centre[key[0]], turn, k)

    on = ["cell", "part", "chunk"]
    found = sent.groupBy(*on).cogroup(dealt.groupBy(*on)).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
