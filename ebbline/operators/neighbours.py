"""Exact nearest neighbours without pairing all rows.

Candidates are cut into cells around a few pivot rows.  The triangle inequality tells which
cells can hold a neighbour, so a row visits only those; big cells are read in blocks of
bounded size.  Tasks emit the best k per row and block, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.operators.ranking import latest_n_skewed, salted_join
from ebbline.session import durable

BLOCK_ROWS = 20_000
QUERY_ROWS = 20_000
CHUNK = 512
VISIT_ROWS = 50_000
#: Distances that one step in a task holds: to pivots (they stay in the processor's cache), to candidates.
PLACED, SCREENED = 1 << 17, 1 << 21


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of squared differences, added up dimension by dimension."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def closest_rows(queries: np.ndarray, points: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the places of its ``take`` nearest points, ties to earlier ones, and the squared distances.

    Products of matrices give bounds of every distance; only points whose lower bound does not exceed the
    ``take``-th upper bound are measured as ``squared_distances`` does.  What has no bound (NaN, infinite) is measured.
    """
    error = np.finfo(np.float64).eps * (4 * queries.shape[1] + 16)
    tiny = np.finfo(np.float64).tiny * (4 * queries.shape[1] + 16)
    places, distances = [], []
    with np.errstate(all="ignore"):
        of_points = (points**2).sum(axis=1)
        step = max(1, min(CHUNK, SCREENED // len(points)))
        for start in range(0, len(queries), step):
            part = queries[start : start + step]
            of_part = (part**2).sum(axis=1)
            upper = part @ points.T
            upper *= -2
            upper += (of_points * (1 + error))[None]
            upper += (of_part * (1 + error) + tiny)[:, None]
            last = np.partition(upper, take - 1, axis=1)[:, take - 1]
            upper -= (2 * error * of_points)[None]
            row, place = np.nonzero(~(upper > (last + 2 * error * of_part + 2 * tiny)[:, None]))
            d = np.zeros(len(row))
            for j in range(points.shape[1]):
                d += (part[row, j] - points[place, j]) ** 2
            order = np.lexsort((place, d, row))
            row, place, d = row[order], place[order], d[order]
            found = np.searchsorted(row, np.arange(len(part)))[:, None] + np.arange(take)
            places.append(place[found])
            distances.append(d[found])
    return np.concatenate(places), np.concatenate(distances)


def distinct_copies(rows: DataFrame, k: int) -> DataFrame:
    """At most ``k + 1`` rows, those with the smallest ids, of every group of equal vectors.

    Neighbours are ordered by distance and id.  Equal vectors tie on distance, so a row's
    nearest k (itself left out) never include a later copy: the answer stays exact.
    """
    kept = latest_n_skewed(rows, ["features"], [F.asc("id")], k + 1)
    return kept.drop("rn")


def _pivots(rows: DataFrame, n: int) -> np.ndarray:
    """A spread sample: the rows with the smallest id hashes."""
    picked = rows.select("features", F.xxhash64("id").alias("_h"), "id").orderBy("_h", "id").limit(n).collect()
    return np.array([r["features"] for r in picked], dtype=np.float64)


def nearest(queries: DataFrame, candidates: DataFrame, k: int, cells: int | None = None) -> DataFrame:
    """(id, rank, neighbour, distance2) of the k nearest candidates other than the row itself.

    Both inputs have (id, features).  The reduced candidates and the distinct queries are
    written once, as several passes read them.
    """
    pool = durable(distinct_copies(candidates.select("id", "features"), k))
    size = pool.count()
    if size == 0:
        empty = "id bigint, rank int, neighbour bigint, distance2 double"
        return queries.sparkSession.createDataFrame([], empty)
    # A visit carries its vector along, so cells are no smaller than a block; screening one is cheap.
    wanted = cells or max(1, min(1024, size // BLOCK_ROWS))
    pivots = _pivots(pool, wanted)
    need = k + 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, PLACED // len(pivots))
        for pdf in batches:
            for start in range(0, len(pdf), step):
                part = pdf.iloc[start : start + step]
                d = np.sqrt(squared_distances(_matrix(part["features"]), pivots))
                cell = d.argmin(axis=1)
                yield part.assign(cell=cell.astype("int32"), reach=d[np.arange(len(d)), cell])

    placed = pool.mapInPandas(place, "id bigint, features array<double>, cell int, reach double")
    # Per cell: rows, radius and the distances of its innermost rows (cells x need values).
    inner = latest_n_skewed(placed.select("id", "cell", "reach"), ["cell"], [F.asc("reach"), F.asc("id")], need)
    stats = (
        placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("radius"))
        .join(inner.groupBy("cell").agg(F.sort_array(F.collect_list("reach")).alias("inner")), "cell")
        .collect()
    )
    radius = np.full(len(pivots), -np.inf)
    closest = np.full((len(pivots), need), np.inf)
    blocks = np.ones(len(pivots), dtype=np.int64)
    for row in stats:
        radius[row["cell"]] = row["radius"]
        closest[row["cell"], : len(row["inner"])] = row["inner"]
        blocks[row["cell"]] = math.ceil(row["n"] / BLOCK_ROWS)

    # Rows with equal vectors share one search.
    asked = queries.select("id", "features")
    unique = durable(asked.groupBy("features").agg(F.min("id").alias("id")))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, min(CHUNK, VISIT_ROWS // len(pivots)))
        for pdf in batches:
            for start in range(0, len(pdf), step):
                part = pdf.iloc[start : start + step]
                d = np.sqrt(squared_distances(_matrix(part["features"]), pivots))
                farthest = np.partition((d[:, :, None] + closest[None]).reshape(len(part), -1), need - 1, axis=1)[:, need - 1]
                slack = 1e-9 * (1.0 + farthest)
                row, cell = np.nonzero(d - radius[None] <= (farthest + slack)[:, None])
                repeat = blocks[cell]
                row, cell = np.repeat(row, repeat), np.repeat(cell, repeat)
                first = np.concatenate(([0], np.cumsum(repeat)[:-1]))
                block = np.arange(len(row)) - np.repeat(first, repeat)
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy()[row],
                        "features": part["features"].to_numpy()[row],
                        "cell": cell.astype("int32"),
                        "block": block.astype("int32"),
                    }
                )

    def lit_array(values: np.ndarray):
        return F.array(*[F.lit(int(v)) for v in values])

    schema = "id bigint, features array<double>, cell int, block int"
    visitors = unique.mapInPandas(visits, schema)
    # Rows per cell that come to look (one number per cell) set how often a cell is repeated.
    groups = np.ones(len(pivots), dtype=np.int64)
    for row in visitors.where("block = 0").groupBy("cell").count().collect():
        groups[row["cell"]] = math.ceil(row["count"] / QUERY_ROWS)
    cell_blocks = F.element_at(lit_array(blocks), F.col("cell") + 1)
    cell_groups = F.element_at(lit_array(groups), F.col("cell") + 1)
    asks = visitors.select("*", F.pmod(F.xxhash64("id"), cell_groups).cast("int").alias("part"))
    offers = placed.select(
        "id",
        "features",
        "cell",
        F.pmod(F.xxhash64("id"), cell_blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), (cell_groups - 1).cast("int"))).alias("part"),
    )

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not (len(left) and len(right)):
            schema = {"qid": "int64", "neighbour": "int64", "distance2": "float64"}
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in schema.items()})
        right = right.sort_values("id")  # ids ascend, so ties go to the smaller id
        take = min(need, len(right))
        place, d = closest_rows(_matrix(left["features"]), _matrix(right["features"]), take)
        ids = right["id"].to_numpy()
        return pd.DataFrame({"qid": np.repeat(left["id"].to_numpy(), take), "neighbour": ids[place].ravel(), "distance2": d.ravel()})

    keys = ["cell", "block", "part"]
    found = asks.groupBy(*keys).cogroup(offers.groupBy(*keys)).applyInPandas(best, "qid bigint, neighbour bigint, distance2 double")
    merged = latest_n_skewed(found, ["qid"], [F.asc("distance2"), F.asc("neighbour")], need)
    lists = merged.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("distance2", "neighbour"))).alias("found"))
    per_vector = unique.withColumnRenamed("id", "qid").join(lists, "qid").select("features", "found")
    back = salted_join(asked, per_vector, ["features"], ["id"])
    own_out = F.slice(F.filter("found", lambda s: s["neighbour"] != F.col("id")), 1, k)
    return back.select("id", F.posexplode(own_out).alias("pos", "hit")).select(
        "id", (F.col("pos") + 1).alias("rank"), F.col("hit.neighbour").alias("neighbour"), F.col("hit.distance2").alias("distance2")
    )
