"""Skew-safe selections equal the plain ones."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ebbline.operators import articles, ranking


def test_salted_top_n_equals_plain(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("k"), (F.hash("id") % 50).alias("v"), "id")
    order = [F.desc("v"), F.asc("id")]
    plain = ranking.latest_n(rows, ["k"], order, 7)
    salted = ranking.latest_n_skewed(rows, ["k"], order, 7)
    assert sorted(plain.collect()) == sorted(salted.collect())


def test_hash_rank_is_the_dense_rank(spark):
    rows = ranking.hashed(spark.range(2000).withColumn("g", F.col("id") % 3), "id")
    got = ranking.hash_rank(rows, ["g"], "id")
    want = rows.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("_h", "id")))
    assert sorted(got.select("id", "rank").collect()) == sorted(want.select("id", F.col("rank").cast("bigint")).collect())


def test_cut_takes_exactly_the_wanted_rows(spark):
    rows = ranking.hashed(spark.range(5000).withColumn("g", F.when(F.col("id") < 4000, 0).otherwise(1)), "id")
    for share, want in ((0.25, {0: 1000, 1: 250}), (1.0, {0: 4000, 1: 1000}), (0.0, {})):
        cut = ranking.hash_cut(rows, ["g"], "id", F.round(F.col("_total") * share))
        taken = rows.join(cut, "g", "left").where(ranking.before_cut("id")).groupBy("g").count()
        assert {r.g: r["count"] for r in taken.collect()} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 80), st.sampled_from("abc")), min_size=1, max_size=40))
def test_run_heads_equal_one_ordered_pass(spark, items):
    rows = [(k, day, i, label) for i, (k, day, label) in enumerate(items)]
    df = spark.createDataFrame(rows, "k int, day int, i int, label string")
    got = ranking.run_heads(df, "k", F.floor(F.col("day") / 10), [("day", True), ("i", True)], "label")
    want = []
    for key in (0, 1):
        last = object()
        for row in sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], -r[2])):
            if row[3] != last:
                want.append(row)
            last = row[3]
    assert sorted(tuple(r) for r in got.select("k", "day", "i", "label").collect()) == sorted(want)


def test_salted_join_equals_join(spark):
    big = spark.range(1000).withColumn("k", F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 10))
    small = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = ranking.salted_join(big, small, ["k"], ["id"], 8)
    assert sorted(got.select("id", "v").collect()) == sorted(big.join(small, "k").select("id", "v").collect())


def test_halves(spark):
    for n in (1, 2, 7, 100):
        parts = {r.part: r["count"] for r in articles.halves(spark.range(n), "id").groupBy("part").count().collect()}
        first = min(n, n // 2 + 1)
        assert parts == {k: v for k, v in ((1, first), (2, n - first)) if v}


def test_cuts_of_one_walk_equal_single_cuts(spark):
    """Tiny groups too, where takes coincide or are zero."""
    rows = [(g, i) for g, n in (("a", 1), ("b", 2), ("c", 3), ("d", 400)) for i in range(n)]
    df = ranking.hashed(spark.createDataFrame(rows, "g string, i int"), "i", F.lit(3), F.col("g"))
    takes = [F.round(F.col("_total") * k / 4) for k in (1, 2, 3)]
    want = {}
    for take in takes:
        for r in ranking.hash_cut(df, ["g"], "i", take).collect():
            want.setdefault(r.g, []).append(tuple(r.cut))
    got = {r.g: sorted(map(tuple, r.cuts)) for r in ranking.hash_cuts(df, ["g"], "i", takes).collect()}
    assert got == {g: sorted(c) for g, c in want.items()}
