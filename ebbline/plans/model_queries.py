"""Queries that resample, train and score."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.operators import asof, boosting, metrics, models, quality, sampling, selection, subwords, terms
from ebbline.plans import features, serving
from ebbline.plans.queries import query, rounded
from ebbline.session import durable, shared_dir, written
from ebbline.sources.domain import Domain

N_CHARS_RULE = 1000


def judged(d: Domain) -> DataFrame:
    """Documents with a quality label and a rule's verdict (long documents are good)."""
    verdict = (F.col("n_chars") >= N_CHARS_RULE).cast("int")
    docs = d.raw("documents").select("doc_id", verdict.alias("prediction"))
    return d.raw("labels").select("doc_id", F.col("quality").alias("label")).join(docs, "doc_id")


def _points(df: DataFrame, digits: int = 5) -> DataFrame:
    """Sampled rows in comparable form: the vector as a sum weighted by place, and its first value."""
    weighted = F.transform("features", lambda x, i: x * (i + 1))
    total = F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)
    return df.select(
        "id", "token", "label", F.round(total, digits).alias("total"), F.round(F.get("features", F.lit(0)), digits).alias("first")
    )


@query
def stratified_split(d: Domain) -> DataFrame:
    return sampling.stratified_split(d.ml_frame(), "id", "label")


@query
def stratified_folds(d: Domain) -> DataFrame:
    return sampling.stratified_folds(d.ml_frame(), "id", "label").select("id", "label", "fold")


@query
def random_oversample(d: Domain) -> DataFrame:
    return _points(sampling.random_oversample(d.ml_frame()))


@query
def smote(d: Domain) -> DataFrame:
    return _points(sampling.smote(durable(d.ml_frame())))


@query
def adasyn_allocation(d: Domain) -> DataFrame:
    return sampling.adasyn_allocation(durable(d.ml_frame()))


@query
def adasyn(d: Domain) -> DataFrame:
    return _points(sampling.adasyn(durable(d.ml_frame())))


@query
def classification_report(d: Domain) -> DataFrame:
    return rounded(metrics.class_report(judged(d), "label", "prediction"))


@query
def split_scoreboard(d: Domain) -> DataFrame:
    """Rule verdicts scored over 30 splits, mean per part."""
    rows = judged(d)
    split = sampling.stratified_split(rows, "doc_id", "label", keep=["prediction"])
    parts = split.withColumn("part", F.when(F.col("is_test"), "test").otherwise("train"))
    return metrics.scoreboard(metrics.class_report(parts, "label", "prediction", ["split", "part"]), ["part"])


#: Settings of the registered booster, which its SQL counterpart repeats.
BOOSTED = boosting.Settings(rounds=2, rate=0.3, depth=2, l1=0.1, l2=1.0, gamma=0.05, least_child=1.0)
BOOSTED_BINS = 8


@query
def boosted_scores(d: Domain) -> DataFrame:
    """Second-order booster on all rows: probability of class 1 after each round."""
    frame = d.ml_frame()
    forest = boosting.fit(frame, BOOSTED, bins=BOOSTED_BINS)
    stages = range(1, BOOSTED.rounds + 1)
    scored = frame.withColumn("_p", boosting.staged_probabilities(forest, F.col("features"), list(stages)))
    return rounded(scored.select("id", "label", *[F.col("_p")[k - 1].alias(f"p_{k}") for k in stages]))


@query
def split_copies(d: Domain) -> DataFrame:
    """How often each row counts in each of the 30 training sets after random oversampling."""
    return selection.split_copies(d.ml_frame())


@query
def boosted_comparison(d: Domain) -> DataFrame:
    """Two boosters x two samplers over 30 splits, 120 models of 5 rounds in one pass."""
    settings = {"plain": boosting.Settings(rounds=5), "regularised": boosting.Settings(rounds=5, l1=0.5, l2=5.0, gamma=0.1)}
    return selection.compare(d.ml_frame(), settings)


@query
def boosted_grid(d: Domain) -> DataFrame:
    """L1 and L2 weights and rounds by 4 folds: 24 models in one pass, rounds read off the longest fit."""
    grid = {"rounds": [2, 5, 10], "l1": [0.0, 0.5], "l2": [0.0, 1.0, 5.0]}
    return rounded(selection.grid_search(d.ml_frame(), grid, boosting.Settings(depth=3)))


@query
def feature_importance(d: Domain) -> DataFrame:
    mart = durable(features.training_mart(d, horizon="6m"))
    names = features.feature_columns()
    model = models.final_model(models.frame(mart, names), "6m")
    return models.importance(model, names, d.spark)


def _scores(d: Domain) -> DataFrame:
    """Live rows scored by one model per horizon; incomplete rows get no score."""
    names = features.feature_columns()
    mart = durable(features.training_mart(d))
    fitted = models.final_models({h: models.frame(mart.where(F.col("horizon") == h), names) for h in asof.HORIZONS})
    # Written before the completeness filter: the optimizer would otherwise rewrite one test per
    # column over all the share expressions.
    live = quality.complete_rows(durable(features.live_features(d, d.data_end))).withColumn("bankruptcy", F.lit(False))
    return models.score(models.frame(live, names), fitted).withColumnRenamed("id", "code")


@query
def score_companies(d: Domain) -> DataFrame:
    return _scores(d)


@query
def score_audit(d: Domain) -> DataFrame:
    """Which companies have scores, and whether the two classes of every horizon add up to 100 per cent."""
    horizons = features.training_mart(d).select("horizon").distinct().count()
    if horizons < len(asof.HORIZONS):  # a model would lack rows to learn from
        return d.companies().select("code", F.lit(False).alias("scored"), F.lit(None).cast("boolean").alias("adds_up"))
    scores = _scores(d)
    right = F.lit(True)
    for h in asof.HORIZONS:
        yes, no = F.col(f"proba_{h}_true"), F.col(f"proba_{h}_false")
        right &= yes.between(0, 100) & no.between(0, 100) & (F.abs(yes + no - 100) < 0.011)
    audited = scores.select("code", right.alias("adds_up"))
    return d.companies().select("code").join(audited, "code", "left").select("code", F.col("adds_up").isNotNull().alias("scored"), "adds_up")


@query
def prediction_panel(d: Domain) -> DataFrame:
    return serving.prediction_panel(d.companies(), _scores(d))


def _tokens(d: Domain) -> DataFrame:
    # As a columnar table: a checkpoint's rows take several times as much disk.
    return written(terms.tokenize(d.raw("documents"), "text", "tokens").select("tokens"))


@query
def skipgram_pairs(d: Domain) -> DataFrame:
    """Weighted pairs of near terms, from which sub-word vectors are trained."""
    tokens = _tokens(d)
    return subwords.pairs(tokens, "tokens", written(subwords.vocabulary(tokens, "tokens")))


@query
def word_vectors(d: Domain) -> DataFrame:
    """Sub-word skip-gram vectors of the documents' terms: length, character runs, and whether the vector is a direction."""
    tokens = _tokens(d)
    words = subwords.vocabulary(tokens, "tokens").select("term")
    vectors = subwords.vectors(subwords.train(tokens, "tokens"), words)
    return vectors.select(
        "term", F.size("vector").alias("dimensions"), F.size(subwords.runs(F.col("term"))).alias("n_runs"),
        (F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x) > 0).alias("has_direction"),
    )


@query
def similar_words(d: Domain) -> DataFrame:
    """Nearest 30 words of the most frequent one, among the 30,000 most frequent."""
    tokens = _tokens(d)
    counts = subwords.vocabulary(tokens, "tokens")
    top = durable(counts.orderBy(F.desc("n"), "term").limit(terms.VOCABULARY))
    known = durable(subwords.vectors(subwords.train(tokens, "tokens"), top))
    word = top.select(F.max_by("term", F.struct("n", "term"))).scalar()
    return rounded(terms.nearest_by_cosine(known, "term", "vector", word))


@query
def model_round_trip(d: Domain) -> DataFrame:
    """A fitted model saved, loaded again and compared with itself on every row."""
    rows = models.as_vectors(d.ml_frame())
    fitted = models.fit(durable(d.ml_frame()), models.boosted_trees(maxIter=3))
    path = f"{shared_dir(d.spark)}/model-{uuid.uuid4().hex}"
    models.save(fitted, path)
    ours, theirs = [m.copy({m.predictionCol: f"_label_{i}", m.probabilityCol: f"_p_{i}", m.rawPredictionCol: f"_raw_{i}"}) for i, m in enumerate((fitted, models.load(path)))]
    both = theirs.transform(ours.transform(rows))
    return both.select("id", ((F.col("_label_0") == F.col("_label_1")) & (F.col("_p_0") == F.col("_p_1"))).alias("same"))
