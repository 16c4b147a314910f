"""Boundary days of the point-in-time features, on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from ebbline.operators import asof, audit, finance, macro, news, prices
from ebbline.operators.quality import complete_rows

D = dt.date


def dim(spark, *rows):
    return spark.createDataFrame([(c, "3m", d) for c, d in rows], "code long, horizon string, as_of date")


def news_case(spark, articles, links, as_of=D(2019, 3, 31)):
    a = spark.createDataFrame(articles, "url string, published_date date, related boolean")
    k = spark.createDataFrame(links, "code long, url string")
    return news.news_ratio(k, a, dim(spark, (1, as_of))).first()


def test_boundary_day_counts_in_both_months_and_month_ends_are_clipped(spark):
    r = news_case(spark, [("a", D(2019, 2, 28), True)], [(1, "a")])
    assert (r.m1, r.m2, r.m3) == (1.0, 1.0, 0.0)


def test_empty_months_are_zero_and_unknown_flags_only_widen_the_denominator(spark):
    r = news_case(spark, [("a", D(2019, 3, 20), True), ("b", D(2019, 3, 21), None)], [(1, "a"), (1, "b")])
    assert r.m1 == 0.5 and r.m1_normal_num == 0 and r.m1_bankruptcy_related_num == 1
    assert r.m7 == 0.0 and r.m7_normal_num == 0


def test_duplicate_links_count_once(spark):
    r = news_case(spark, [("a", D(2019, 3, 20), False)], [(1, "a"), (1, "a")])
    assert r.m1_normal_num == 1


def test_companies_without_news_keep_a_row(spark):
    assert news_case(spark, [], []).m12 == 0.0


def price_rows(spark, ages, as_of=D(2020, 1, 1), close=1.0, qty=1.0):
    rows = [(1, as_of - dt.timedelta(days=a), close, qty, qty, qty, qty, qty, qty, 0.0, 0.0, 0.0) for a in ages]
    cols = "sell_foreign sell_inst sell_indiv buy_foreign buy_inst buy_indiv ret_1m ret_3m ret_6m".split()
    return spark.createDataFrame(rows, "code long, date date, close double, " + ", ".join(f"{c} double" for c in cols))


def test_window_ends_differ_between_training_and_live(spark):
    edge = [0, 30, 31, 60, 61, 90, 91, 120]
    d = dim(spark, (1, D(2020, 1, 1)))
    assert prices.share_deltas(price_rows(spark, edge), d).count() == 0
    assert prices.share_deltas(price_rows(spark, edge), d, bounds="live").count() == 1


def test_companies_lacking_a_window_or_any_volume_are_dropped(spark):
    d = dim(spark, (1, D(2020, 1, 1)))
    assert prices.share_deltas(price_rows(spark, [5, 40, 70]), d).count() == 0
    assert prices.share_deltas(price_rows(spark, [5, 40, 70, 100], qty=0.0), d).count() == 0
    assert prices.share_deltas(price_rows(spark, [5, 40, 70, 100], close=None), d).count() == 0
    assert prices.share_deltas(price_rows(spark, [5, 40, 70, 100]), d).first().foreign_sell_r1_r2 == 0.0


def test_look_back_spans_the_days_before_the_cut_off(spark):
    rows = prices.look_back(price_rows(spark, [0, 1, 1097, 1098]), dim(spark, (1, D(2020, 1, 1))))
    assert rows.count() == 2


def statement(spark, *years, month=12):
    measures = [m for m in finance.STATEMENT_MEASURES if m != "debt_to_assets"]
    schema = "code long, fiscal_year int, closing_month int, " + ", ".join(f"{m} double" for m in measures)
    return spark.createDataFrame([(1, y, month, *[float(y)] * len(measures)) for y in years], schema)


def test_a_filing_due_on_the_cut_off_day_is_not_known(spark):
    rows = statement(spark, 2016, 2017, 2018)
    due = D(2019, 3, 31)  # 31 December 2018 and 90 days
    on_day = finance.latest_statements(rows, dim(spark, (1, due)), 2).first()
    day_after = finance.latest_statements(rows, dim(spark, (1, due + dt.timedelta(days=1))), 2).first()
    assert (on_day.y1_sales, on_day.y2_sales) == (2017.0, 2016.0)
    assert (day_after.y1_sales, day_after.y2_sales) == (2018.0, 2017.0)


def test_one_statement_is_not_enough_for_two_years(spark):
    wide = finance.latest_statements(statement(spark, 2017), dim(spark, (1, D(2019, 1, 1))), 2)
    assert wide.count() == 1 and complete_rows(wide).count() == 0


def series(spark, months):
    rows = [(D(y, m, 1), float(y * 100 + m), 0.0, 0.0, 0.0, 0.0) for y, m in months]
    return spark.createDataFrame(rows, "month date, oil_price double, oil_price_yoy double, cd91 double, bond3y double, usdkrw double")


def test_a_month_is_public_on_the_eighth_of_the_next(spark):
    s = series(spark, [(2018, m) for m in range(1, 13)] + [(2019, 1), (2019, 2)])
    eighth = macro.macro_asof(s, dim(spark, (1, D(2019, 3, 8)))).first()
    seventh = macro.macro_asof(s, dim(spark, (1, D(2019, 3, 7)))).first()
    assert eighth.m1_oil_price == 201902.0 and eighth.m2_oil_price == 201901.0
    assert seventh.m1_oil_price == 201901.0 and seventh.m12_oil_price == 201802.0


def test_live_publication_is_the_first_of_the_next_month_and_gaps_are_null(spark):
    s = series(spark, [(2019, 2), (2018, 12)])
    r = macro.macro_asof(s, dim(spark, (1, D(2019, 3, 1))), rule="live").first()
    assert (r.m1_oil_price, r.m2_oil_price, r.m3_oil_price) == (201902.0, None, 201812.0)


def audits(spark, rows):
    return spark.createDataFrame(rows, "code long, report_date date, n_opinion boolean, order_key long")


def test_three_newest_reports_with_undated_ones_last(spark):
    d = dim(spark, (1, D(2019, 1, 1)))
    dated = [(1, D(2018, m, 1), False, m) for m in (1, 2, 3)]
    doubted = audits(spark, [*dated, (1, None, True, 9)])
    assert audit.any_recent_doubt(doubted, d, ["order_key"]).first().n_opinion_in_r3 is False
    assert audit.any_recent_doubt(audits(spark, [*dated[:2], (1, None, True, 9)]), d, ["order_key"]).first().n_opinion_in_r3
    unknown = audits(spark, [(1, D(2018, 1, 1), None, 1)])
    assert audit.any_recent_doubt(unknown, d, ["order_key"]).first().n_opinion_in_r3 is False
    later = audits(spark, [(1, D(2019, 1, 1), True, 1)])
    assert audit.any_recent_doubt(later, d, ["order_key"]).count() == 0
    assert audit.any_recent_doubt(later, d, ["order_key"], published_only=False).count() == 1


def test_filings_skip_corrections_late_ones_and_repeated_periods(spark):
    companies = spark.createDataFrame([("1", D(2019, 6, 1)), ("2", None)], "code string, delisted_date date")
    rows = [
        ("감사보고서 (2018.12)", "20190701", "f7"),
        ("[정정]감사보고서 (2018.12)", "20190520", "f6"),
        ("감사보고서 (2018.12)", "20190510", "f5"),
        ("감사보고서 (2018.12)", "20190401", "f4"),
        ("감사보고서 (2017.12)", "20180401", "f3"),
        ("감사보고서 (2018.12)", "20170401", "f2"),
    ]
    filings = spark.createDataFrame([(c, *r) for c in ("1", "2") for r in rows], "code string, rpt_nm string, rcp_dt string, rcp_no string")
    got = audit.select_filings(filings, companies, "u/").orderBy("code", "filed_on", ascending=False).collect()
    by = {c: [(r.report_name, r.url) for r in got if r.code == c] for c in ("1", "2")}
    assert sorted(by["1"]) == [("A-1", "u/f5"), ("A-2", "u/f3"), ("A-3", "u/f2")]
    assert len(by["2"]) == 5 and ("A-1", "u/f7") in by["2"]


def test_horizons_are_read_by_name(spark):
    c = spark.createDataFrame([(1, D(2019, 1, 1), D(2019, 2, 2), D(2019, 3, 3))], "code long, pre_1y date, pre_3m date, pre_6m date")
    got = {r.horizon: r.as_of for r in asof.horizons(c).collect()}
    assert got == {"3m": D(2019, 2, 2), "6m": D(2019, 3, 3), "1y": D(2019, 1, 1)}


def test_date_filters_reach_the_scan(spark, tmp_path):
    rows = spark.range(1000).select("id", F.expr("date_add(DATE '2010-01-01', cast(id as int))").alias("date"))
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    near = asof.within_reach(table, "date", dim(spark, (1, D(2011, 1, 1))), days=10)
    assert near.count() == 11
    assert "PushedFilters: [IsNotNull(date)" in near._jdf.queryExecution().toString()
