"""Files, reshaping and checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.operators import articles, quality, reshape
from ebbline.plans import serving
from ebbline.sources import files, keyed


def test_codes_keep_leading_zeros_and_measures_become_doubles(spark, tmp_path):
    rows = spark.createDataFrame([("000660", "a, \"b\"", 1.5), ("005930", None, None)], "stock_code string, name string, close double")
    files.export_csv(rows, str(tmp_path / "t"))
    keys = {"stock_code": T.StringType(), "name": T.StringType()}
    back = files.scan_csv(spark, str(tmp_path / "t"), keys)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert files.scan_csv(spark, str(tmp_path / "t"), keys, columns=["close"]).columns == ["close"]


def test_bodies_with_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([("u", 'line\n"two"')], "url string, body string")
    files.export_csv(rows, str(tmp_path / "t"))
    keys = {"url": T.StringType(), "body": T.StringType()}
    assert files.scan_csv(spark, str(tmp_path / "t"), keys, multi_line=True).first().body == 'line\n"two"'


def test_split_files_have_headers_and_bounded_length(spark, tmp_path):
    files.split_csv(spark.range(25).coalesce(1), str(tmp_path / "s"), lines=10)
    parts = [p.read_text().splitlines() for p in (tmp_path / "s").glob("*.csv")]
    assert sorted(len(p) - 1 for p in parts) == [5, 10, 10] and all(p[0] == "id" for p in parts)


def test_append_and_load(spark, tmp_path):
    target = str(tmp_path / "t")
    files.load_table(spark.range(3), target)
    files.append_table(spark.range(2), target)
    assert spark.read.parquet(target).count() == 5
    files.load_table(spark.range(1), target)
    assert spark.read.parquet(target).count() == 1


def test_marks_and_nan(spark):
    df = spark.createDataFrame([(1.0, float("nan"), None), (0.0, 2.0, 1.0)], "a double, b double, c double")
    rows = files.fill_missing_bool(files.nan_as_null(df), ["a", "c"]).collect()
    assert [tuple(r) for r in rows] == [(True, None, False), (False, 2.0, True)]


def test_vendor_file_to_daily_rows(spark):
    wide = spark.createDataFrame(
        [("000660", "n", "종가(원)", "1", "3"), ("000660", "n", "거래량(주)", "2", None)],
        ["stock_code", "company_name", "item_name", "2019-01-02", "2019-01-03"],
    )
    items = {"종가(원)": "close", "거래량(주)": "volume", "수익률(%)": "ret"}
    daily = reshape.vendor_to_daily(wide, ["stock_code", "company_name", "item_name"], "item_name", items)
    got = {r.date: (r.close, r.volume, r.ret) for r in daily.collect()}
    assert got == {dt.date(2019, 1, 2): ("1", "2", None), dt.date(2019, 1, 3): ("3", None, None)}


def test_relabel_and_units(spark):
    df = spark.createDataFrame([(1, 2)], ["a(%)", "b"])
    assert reshape.ascii_units(df).columns == ["a(p)", "b"]
    assert reshape.relabel(df, ["x", "y"]).columns == ["x", "y"]


def test_no_tag_is_an_empty_array(spark):
    a = spark.createDataFrame([("u",), ("v",)], "url string")
    k = spark.createDataFrame([("2", "u"), ("1", "u"), ("1", "u")], "code string, url string")
    tags = {r.url: r.tags for r in articles.article_tags(a, k).collect()}
    assert tags == {"u": ["1", "2"], "v": []}
    assert articles.with_tag(articles.article_tags(a, k), F.lit("2")).count() == 1


def test_pending_drops_null_and_done(spark):
    wanted = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "url string")
    assert [r.url for r in articles.pending(wanted, spark.createDataFrame([("b",)], "url string"), "url").collect()] == ["a"]


def test_page_tables_are_found_by_code(spark, tmp_path):
    serving.publish(spark.range(100).withColumn("code", F.col("id") % 10), str(tmp_path / "t"))
    found = serving.lookup(spark, str(tmp_path / "t"), 3)
    assert found.count() == 10
    assert "PushedFilters: [IsNotNull(code), EqualTo(code,3)]" in found._jdf.queryExecution().toString()


def test_report_counts(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, "y"), (None, "z")], "k int, v string")
    other = spark.createDataFrame([(1, True, None), (5, None, "w")], "k int, good boolean, v string")
    rows = quality.key_report(
        quality.Checked("t", df, "k", nulls=["v"]), quality.Checked("d", other, "k", nulls=["v"], labels=["good"]),
        unique=["t", "d"], orphans=[("t", "d"), ("d", "t")], sizes=["t", "d"],
    )
    assert {(r.check, r.table_name, r.column_name): r.n for r in rows.collect()} == {
        ("duplicate_keys", "t", "k"): 1, ("duplicate_keys", "d", "k"): 0, ("orphans", "t", "k"): 2, ("orphans", "d", "k"): 1,
        ("nulls", "t", "v"): 1, ("nulls", "d", "v"): 1, ("positives", "d", "good"): 1,
        ("rows", "t", "k"): 4, ("distinct", "t", "k"): 2, ("rows", "d", "k"): 2, ("distinct", "d", "k"): 2,
    }
    empty = quality.key_report(quality.Checked("t", df.limit(0), "k", nulls=["v"]), unique=["t"], sizes=["t"])
    assert [r.n for r in empty.collect()] == [0, 0, 0, 0]


def test_keyed_table_is_updated_widened_and_extended(spark, tmp_path):
    target = str(tmp_path / "t")
    keyed.store(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, v string, x double"), target, "k", folders=4)
    changes = spark.createDataFrame([(2, None, True), (3, "c", False)], "k int, v string, seen boolean")
    for _ in range(2):  # run again: the same table
        keyed.merge(spark, target, "k", changes, folders=4)
        got = {(r.k, r.v, r.x, r.seen) for r in keyed.read(spark, target).collect()}
        assert got == {(1, "a", 1.0, None), (2, None, 2.0, True), (3, "c", None, False), (None, "n", 0.0, None)}
    keyed.merge(spark, target, "k", spark.createDataFrame([(1, "z"), (9, "y")], "k int, v string"), insert=False, folders=4)
    got = {(r.k, r.v) for r in keyed.read(spark, target).collect()}
    assert got == {(1, "z"), (2, None), (3, "c"), (None, "n")}
    keyed.merge(spark, target, "k", changes.limit(0), folders=4)
    assert keyed.read(spark, target).count() == 4
    with pytest.raises(ValueError, match="repeat"):
        keyed.merge(spark, target, "k", changes.union(changes), folders=4)


def test_merge_leaves_other_folders_alone(spark, tmp_path):
    target = tmp_path / "t"
    keyed.store(spark.range(1_000).toDF("k").withColumn("v", F.lit(0)), str(target), "k")
    before = {f: f.stat().st_mtime_ns for f in target.rglob("*.parquet")}
    keyed.merge(spark, str(target), "k", spark.range(7, 8).toDF("k").withColumn("v", F.lit(1)))
    after = {f: f.stat().st_mtime_ns for f in target.rglob("*.parquet")}
    assert len(before.items() & after.items()) == len(before) - 1
    assert [(r.n, r.s) for r in keyed.read(spark, str(target)).agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()] == [(1_000, 1)]
