from pyspark.sql import functions as F

from ebbline.operators import articles, bloom


def test_no_key_is_missed_and_few_pass_by_mistake(spark):
    keys, others = spark.range(20_000).withColumnRenamed("id", "k"), spark.range(20_000, 60_000).withColumnRenamed("id", "k")
    n = bloom.words_for(20_000)
    made = bloom.key_filter(keys.union(spark.sql("SELECT CAST(NULL AS BIGINT) AS k")), "k", n)
    assert made.count() <= n
    share = lambda df: df.agg(F.avg(F.col("hit").cast("int"))).first()[0]
    assert share(bloom.probed(keys, "k", made, n, "hit")) == 1
    assert 0 < share(bloom.probed(others, "k", made, n, "hit")) < 0.03


def test_pending_is_exact_with_false_positives(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_WORDS", 4)  # 256 bits for thousands of keys: nearly all pass
    wanted = spark.range(3_000).selectExpr("CAST(id AS STRING) AS url").union(spark.sql("SELECT '7' UNION ALL SELECT NULL"))
    done = spark.range(0, 30_000, 3).selectExpr("CAST(id AS STRING) AS url")
    got = [r.url for r in articles.pending(wanted, done, "url").collect()]
    assert sorted(got) == sorted(str(i) for i in range(3_000) if i % 3)


def test_pending_probes_before_the_anti_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = spark.range(100).selectExpr("id AS url")
        plan = articles.pending(wanted, spark.range(50).selectExpr("id AS url"), "url")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "bit_or" in plan and "BroadcastHashJoin" in plan and plan.index("LeftAnti") < plan.index("BroadcastHashJoin")


def test_pending_of_empty_tables(spark):
    none, some = spark.createDataFrame([], "url string"), spark.createDataFrame([("a",), (None,)], "url string")
    assert articles.pending(none, some, "url").count() == 0
    assert [r.url for r in articles.pending(some, none, "url").collect()] == ["a"]
