"""Second-order gradient boosting of trees: many models in one pass over one binned frame.

Features are cut into quantile bins once.  A level of all trees of all models costs one pass: each
task adds up gradients and Hessians per (model, node, feature, bin) of its rows, one grouped
aggregation sums the tasks, and running sums over the bins give every split's gain.  The driver
sees one row per node.  What a task holds is models x nodes x features x bins, whatever the rows.

Gradients and Hessians are whole numbers (``UNIT`` to one), so sums don't depend on the order of
rows, tasks or retries, and equal data give equal trees.  Rows and columns are sampled by hash.

Models differ in their settings and in the whole-number weights they give to rows: splits and folds
are weights of zero, oversampling is weights above one, and nothing is copied.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.session import discard, written

BINS = 32
UNIT = 1 << 20
SEED = 20
#: Rounds between two writes of the margins; in between, newer trees are applied on the fly.
WRITE_EVERY = 10
#: Histogram cells a task may hold; models beyond it are grown in groups.
CELLS = 1 << 24
_GOLDEN = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Settings:
    """``least_child`` is a sum of Hessians; ``rows`` and ``columns`` are the shares drawn per tree."""

    rounds: int = 100
    rate: float = 0.1
    depth: int = 3
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    least_child: float = 1.0
    rows: float = 1.0
    columns: float = 1.0


@dataclass
class Forest:
    """Trees in heap order (children of node i: 2i + 1 and 2i + 2), one row of arrays per round.

    ``feature`` is -1 in leaves; rows with a value up to ``edges[feature][cut]`` go left.
    """

    settings: Settings
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def margins(self, bins: np.ndarray, rounds: Sequence[int] | None = None) -> np.ndarray:
        """Log-odds of binned rows after each of ``rounds`` trees (all, if not given): rows x rounds."""
        wanted = [len(self.feature)] if rounds is None else list(rounds)
        out, now, last = np.empty((len(bins), len(wanted))), np.zeros(len(bins)), 0
        for k in np.argsort(wanted, kind="stable"):
            for r in range(last, min(wanted[k], len(self.feature))):
                now = now + self.value[r][_leaves(bins, self.feature[r], self.cut[r])]
            last = max(last, wanted[k])
            out[:, k] = now
        return out

    def importance(self) -> np.ndarray:
        """Share of each feature in the summed gain of all splits."""
        split = self.feature >= 0
        total = np.bincount(self.feature[split], weights=self.gain[split], minlength=len(self.edges))
        return total / total.sum() if total.sum() else total


def _leaves(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Node in which every row ends."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            return node
        right = bins[rows, np.maximum(f, 0)] > cut[node]
        node = np.where(inner, 2 * node + 1 + right, node)


def quantile_edges(df: DataFrame, n_features: int, bins: int = BINS, accuracy: int = 10_000) -> list[np.ndarray]:
    """Upper edges of the bins of every feature: its distinct quantiles, at most ``bins - 1`` of them."""
    shares = [i / bins for i in range(1, bins)]
    shares = [i / bins for i in range(1, bins)]
    values = df.select(F.posexplode("features").alias("at", "value")).where("value IS NOT NULL")
    found = values.groupBy("at").agg(F.percentile_approx("value", shares, accuracy).alias("cuts")).collect()
    cuts = {r["at"]: r.cuts for r in found}  # one row per feature
    return [np.unique(np.array(cuts.get(i, []), float)) for i in range(n_features)]


def binned_matrix(features: pd.Series, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers, rows x features; missing values go to the lowest bin."""
    values = np.stack(features.to_numpy()) if len(features) else np.empty((0, len(edges)))
    values = np.where(np.isnan(values.astype(float)), -np.inf, values.astype(float))
    bins = np.empty((len(values), len(edges)), np.uint8)
    for i, e in enumerate(edges):
        bins[:, i] = np.searchsorted(e, values[:, i])
    return bins


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(ids: np.ndarray, model: int, round_: int, share: float) -> np.ndarray:
    """Rows of a tree, by the hash of their id."""
    salt = np.uint64((SEED + 1_000_003 * model + round_) * _GOLDEN % 2**64)
    return (_mix(ids.view(np.uint64) ^ salt) >> np.uint64(11)).astype(float) < share * 2.0**53


def _columns(model: int, round_: int, n: int, share: float) -> np.ndarray:
    """Features that a tree may use."""
    salt = np.uint64((SEED + 7_000_003 * model + 13 * round_ + 5) * _GOLDEN % 2**64)
    order = np.argsort(_mix(np.arange(n, dtype=np.uint64) * np.uint64(_GOLDEN) ^ salt), kind="stable")
    return np.sort(order[: max(1, int(share * n))])


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the log loss in whole units."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - label) * UNIT).astype(np.int64), np.rint(p * (1.0 - p) * UNIT).astype(np.int64)


class _Growing:
    """The trees of all models so far; what a task needs to place a row."""

    def __init__(self, settings: Sequence[Settings], n_features: int, n_bins: int):
        self.settings, self.n_features, self.n_bins = list(settings), n_features, n_bins
        self.nodes = 2 ** (max(s.depth for s in settings) + 1) - 1
        self.written = 0
        self.feature, self.cut, self.value, self.gain = [], [], [], []

    def begin(self) -> None:
        shape = len(self.settings), self.nodes
        self.feature.append(np.full(shape, -1, np.int16))
        self.cut.append(np.zeros(shape, np.int16))
        self.value.append(np.zeros(shape))
        self.gain.append(np.zeros(shape))

    def tail(self, start: int) -> _Growing:
        """A copy with the trees from round ``start`` on."""
        copy = _Growing(self.settings, self.n_features, self.n_bins)
        copy.written = start
        copy.feature, copy.cut, copy.value = self.feature[start:], self.cut[start:], self.value[start:]
        return copy

    def add(self, margins: np.ndarray, bins: np.ndarray, trees: int) -> None:
        """Add the first ``trees`` trees to margins (rows x models)."""
        for r in range(trees):
            for m in range(len(self.settings)):
                if (self.feature[r][m, 0] >= 0) or self.value[r][m, 0]:
                    margins[:, m] += self.value[r][m][_leaves(bins, self.feature[r][m], self.cut[r][m])]


def _arrays(batch: pd.DataFrame, n_features: int, n_models: int):
    def stacked(column: str, kind, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(batch[column]), kind).reshape(len(batch), width)

    return stacked("bins", np.uint8, n_features), stacked("weights", np.int32, n_models), stacked("margins", np.float64, n_models).copy()


def _histograms(batches: Iterator[pd.DataFrame], trees: _Growing, round_: int, level: int) -> Iterator[pd.DataFrame]:
    """Sums of whole gradients and Hessians of a task's rows: (model, node, feature, bin, g, h)."""
    n_models, n_features, n_bins = len(trees.settings), trees.n_features, trees.n_bins
    first, width = 2**level - 1, 2**level
    sums = np.zeros((2, n_models, width, n_features, n_bins), np.int64)
    for batch in batches:
        bins, weights, margins = _arrays(batch, n_features, n_models)
        trees.add(margins, bins, len(trees.feature) - 1)
        ids, label = batch["key"].to_numpy(), batch["label"].to_numpy()
        cell = np.arange(n_features) * n_bins + bins
        for m, s in enumerate(trees.settings):
            if round_ >= s.rounds or level >= s.depth:
                continue
            node = _leaves(bins, trees.feature[-1][m], trees.cut[-1][m])
            used = (weights[:, m] > 0) & (node >= first)
            if s.rows < 1:
                used &= _drawn(ids, m, round_, s.rows)
            g, h = (x * weights[used, m] for x in gradients(margins[used, m], label[used]))
            columns = _columns(m, round_, n_features, s.columns)
            place = ((node[used] - first)[:, None] * (n_features * n_bins) + cell[used][:, columns]).ravel()
            for k, x in enumerate((g, h)):
                # Sums of whole numbers below 2**53 are exact in doubles.
                added = np.bincount(place, weights=np.repeat(x, len(columns)).astype(float), minlength=width * n_features * n_bins)
                sums[k, m] += added.astype(np.int64).reshape(width, n_features, n_bins)
    model, node, feature, bin_ = np.nonzero((sums != 0).any(axis=0))
    at = model, node, feature, bin_
    yield pd.DataFrame({"model": model, "node": node + first, "feature": feature, "bin": bin_, "g": sums[0][at], "h": sums[1][at]})


def _score(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    """Gain of a node: the squared gradient beyond the L1 weight over Hessian and L2 weight."""
    beyond = np.maximum(np.abs(g / UNIT) - s.l1, 0.0)
    below = h / UNIT + s.l2
    return np.divide(beyond * beyond, below, out=np.zeros(len(below)), where=below > 0)


def _best(batches: Iterator[pd.DataFrame], settings: Sequence[Settings]) -> Iterator[pd.DataFrame]:
    """The best split of every (model, node) among the whole features of a partition."""
    rows = pd.concat(list(batches), ignore_index=True)
    if not len(rows):
        return
    rows = rows.sort_values(["model", "node", "feature", "bin"], kind="stable")
    group = rows.groupby(["model", "node", "feature"], sort=False)
    rows = rows.assign(
        gl=group["g"].cumsum(), hl=group["h"].cumsum(), total_g=group["g"].transform("sum"), total_h=group["h"].transform("sum"), gain=-1.0
    )
    for model, part in rows.groupby("model", sort=False):
        s = settings[model]
        gl, hl, g, h = (part[c].to_numpy() for c in ("gl", "hl", "total_g", "total_h"))
        gr, hr = g - gl, h - hl
        gain = 0.5 * (_score(gl, hl, s) + _score(gr, hr, s) - _score(g, h, s)) - s.gamma
        fair = (np.minimum(hl, hr) >= s.least_child * UNIT) & (np.minimum(hl, hr) > 0) & (gain > 1e-9)
        rows.loc[part.index, "gain"] = np.where(fair, gain, -1.0)
    first = rows.sort_values(["gain", "feature", "bin"], ascending=[False, True, True], kind="stable").drop_duplicates(["model", "node"])
    yield first.drop(columns=["g", "h"]).rename(columns={"total_g": "g", "total_h": "h"})[BEST]


BEST = ["model", "node", "gain", "feature", "bin", "gl", "hl", "g", "h"]


def best_splits(histograms: DataFrame, settings: Sequence[Settings]) -> dict[tuple[int, int], dict]:
    """Per (model, node) the sums ``g, h`` and the split of the largest gain (-1: none is positive).

    Ties go to the lower feature, then bin.  A feature's bins meet in one partition and the partitions'
    winners on the driver: one row per node and partition.
    """
    summed = (
        histograms.repartition("model", "node", "feature").groupBy("model", "node", "feature", "bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    )
    schema = "model int, node int, gain double, feature int, bin int, gl bigint, hl bigint, g bigint, h bigint"
    found = summed.mapInPandas(lambda b: _best(b, settings), schema).collect()
    out: dict[tuple[int, int], dict] = {}
    for x in sorted(found, key=lambda x: (-x.gain, x.feature, x.bin)):
        out.setdefault((x.model, x.node), x)
    return out


def leaf_value(g: float, h: float, s: Settings) -> float:
    g, h = g / UNIT, h / UNIT + s.l2
    return -s.rate * float(np.sign(g)) * max(abs(g) - s.l1, 0.0) / h if h > 0 else 0.0


def _advanced(batches: Iterator[pd.DataFrame], trees: _Growing) -> Iterator[pd.DataFrame]:
    for batch in batches:
        bins, _, margins = _arrays(batch, trees.n_features, len(trees.settings))
        trees.add(margins, bins, len(trees.feature))
        yield batch.assign(margins=[m.tobytes() for m in margins])


ROWS = "key bigint, label int, bins binary, weights binary, margins binary"


def _prepared(df: DataFrame, edges: list[np.ndarray], n_models: int, id_col: str) -> DataFrame:
    """Binned rows with weights and margins of all models."""
    weights = F.col("weights") if "weights" in df.columns else F.array_repeat(F.lit(1), n_models)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "key": batch["key"], "label": batch["label"], "bins": [b.tobytes() for b in binned_matrix(batch["features"], edges)],
                    "weights": [np.asarray(w, np.int32).tobytes() for w in batch["weights"]], "margins": np.zeros(n_models).tobytes(),
                }
            )

    chosen = df.select(F.xxhash64(F.col(id_col)).alias("key"), F.col("label").cast("int").alias("label"), "features", weights.cast("array<int>").alias("weights"))
    return written(chosen.mapInPandas(rows, ROWS))


def fit_many(
    df: DataFrame, settings: Sequence[Settings], edges: list[np.ndarray] | None = None, bins: int = BINS, id_col: str = "id"
) -> list[Forest]:
    """One forest per entry of ``settings`` from ``df`` (id, features, label and, if wanted, weights).

    ``weights`` is an array of whole numbers, one per model; rows of weight zero don't count for that
    model.  All rows must have the same number of features; a missing value counts as the lowest.
    A model without rows or with one class grows leaves only.  An empty table gives forests of
    no splits.
    """
    spark = df.sparkSession
    if not settings:
        return []
    if edges is None:
        width = df.select(F.max(F.size("features"))).first()[0] or 0
        edges = quantile_edges(df, width, bins)
    n_bins = max([len(e) for e in edges], default=0) + 1
    most = max(1, CELLS // max(1, 2 ** max(s.depth for s in settings) * len(edges) * n_bins))
    if len(settings) > most:
        out: list[Forest] = []
        for start in range(0, len(settings), most):
            group = settings[start : start + most]
            part = df.withColumn("weights", F.slice("weights", start + 1, len(group))) if "weights" in df.columns else df
            out += fit_many(part, group, edges, bins, id_col)
        return out
    rows = _prepared(df, edges, len(settings), id_col)
    trees, start = _Growing(settings, len(edges), n_bins), 0
    for round_ in range(max(s.rounds for s in settings)):
        trees.begin()
        for level in range(max(s.depth for s in settings)):
            open_nodes = 0
            known = spark.sparkContext.broadcast(trees.tail(start))
            found = best_splits(
                rows.mapInPandas(
                    lambda b, known=known, r=round_, d=level: _histograms(b, known.value, r, d),
                    "model int, node int, feature int, bin int, g bigint, h bigint",
                ),
                settings,
            )
            for x in found.values():
                s = settings[x.model]
                if level == 0:
                    trees.value[-1][x.model, 0] = leaf_value(x.g, x.h, s)
                if x.gain > 0:
                    trees.feature[-1][x.model, x.node], trees.cut[-1][x.model, x.node] = x.feature, x.bin
                    trees.gain[-1][x.model, x.node] = x.gain
                    trees.value[-1][x.model, x.node] = 0.0
                    trees.value[-1][x.model, 2 * x.node + 1] = leaf_value(x.gl, x.hl, s)
                    trees.value[-1][x.model, 2 * x.node + 2] = leaf_value(x.g - x.gl, x.h - x.hl, s)
                    open_nodes += level + 1 < s.depth
            known.destroy()
            if not open_nodes:
                break
        if len(trees.feature) - start >= WRITE_EVERY:
            known = spark.sparkContext.broadcast(trees.tail(start))
            older, start = rows, len(trees.feature)
            rows = written(rows.mapInPandas(lambda b, known=known: _advanced(b, known.value), ROWS))
            discard(older)
    discard(rows)
    stacked = [np.stack(x, axis=1) for x in (trees.feature, trees.cut, trees.value, trees.gain)]
    return [Forest(s, edges, *[x[m, : s.rounds] for x in stacked]) for m, s in enumerate(settings)]


def fit(df: DataFrame, settings: Settings = Settings(), **options) -> Forest:
    return fit_many(df, [settings], **options)[0]


def probability(forest: Forest, features: Column) -> Column:
    """Probability of class 1, in Arrow batches."""

    @F.pandas_udf("double")
    def scored(values: pd.Series) -> pd.Series:
        return pd.Series(1.0 / (1.0 + np.exp(-forest.margins(binned_matrix(values, forest.edges))[:, 0])))

    return scored(features)


def staged_probabilities(forest: Forest, features: Column, rounds: Sequence[int]) -> Column:
    """Probabilities after each of ``rounds`` trees: one fit of the most rounds serves a whole grid of them."""

    @F.pandas_udf("array<double>")
    def scored(values: pd.Series) -> pd.Series:
        return pd.Series(list(1.0 / (1.0 + np.exp(-forest.margins(binned_matrix(values, forest.edges), rounds)))))

    return scored(features)


def tree_table(forest: Forest, spark) -> DataFrame:
    """(round, node, feature, threshold, value, gain) of the nodes in use; what is stored of a model."""
    rows = []
    for r, (feature, cut, value, gain) in enumerate(zip(forest.feature, forest.cut, forest.value, forest.gain)):
        used = [0]
        while used:
            i = used.pop()
            f = int(feature[i])
            threshold = float(forest.edges[f][cut[i]]) if f >= 0 else None
            rows.append((r, i, f, threshold, float(value[i]), float(gain[i])))
            used += [2 * i + 1, 2 * i + 2] if f >= 0 else []
    return spark.createDataFrame(rows, "round int, node int, feature int, threshold double, value double, gain double")
