"""Text rules against Python's own regular expressions, and page extraction."""

import re

from pyspark.sql import functions as F

from ebbline.functions import html as H
from ebbline.functions import text as T
from ebbline.operators import articles, terms
from ebbline.streaming import intake


def python_cleanse(text):
    """The documented passes (fixed patterns), run by Python one after the other."""
    for pattern, to in (
        (r"googletag.*\}\);", " "),
        (r"\s+", " "),
        (r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+", ""),
        (r"(http|ftp|https)://(?:[-\w.]|(?:%[\da-fA-F]{2}))+", ""),
        (r"[ㄱ-ㅎㅏ-ㅣ]+", ""),
        (r"<[^>]*>", ""),
        (r"[^\w\s]", ""),
    ):
        text = re.sub(pattern, to, text)
    return text


SAMPLES = [
    "a googletag.cmd({x});\nb",
    "googletag.one }); keep googletag.two }); rest });",
    "mail a.b+c@d-e.co.kr, see https://ex.kr/a/b?x=%41 end",
    "ㅋㅋㅋ 부도ㅠㅠ <b\nclass='x'>굵게</b> 3 < 4 > 2",
    "½ ² Ⅳ ٣ é é ﬁ _x_ “인용” … \xa0　\x1c\x85끝",
    "",
]


def test_cleanse_equals_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, t string")
    got = [r.c for r in df.orderBy("i").select(T.cleanse(F.col("t")).alias("c")).collect()]
    assert got == [python_cleanse(s) for s in SAMPLES]


def test_cleanse_equals_python_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", T.cleanse(F.col("text")).alias("c"))
    assert all(r.c == python_cleanse(r.text) for r in docs.collect())


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*columns).first()


def test_press_passes(spark):
    raw = "<기자> \n<서울> Done ◆말■ googletag.x });끝 저작권자 ⓒ 서울경제, 무단 전재 및 재배포 금지"
    assert one(spark, raw, T.cleanse_press(F.col("t")))[0] == "one 말 끝 "


def test_keywords_and_doubts(spark):
    df = spark.createDataFrame([("대규모부도설",), ("평온",), (None,)], "t string")
    flags = [r[0] for r in df.select(T.contains_any(F.col("t"), T.DISTRESS_TERMS)).collect()]
    assert flags == [True, False, False]
    cases = {"계속기업 불확실. 끝.": True, "계속기업. 의문.": False, "계속기업으로서 존속에 의문.": True, None: None}
    for text, want in cases.items():
        assert one(spark, text, T.going_concern(F.col("t")))[0] is want


def test_flagging_uses_the_cleaned_body(spark):
    df = spark.createDataFrame([("부-도",), ("회 생",)], "body string")
    assert [r.related for r in articles.flag_articles(df, "body").collect()] == [True, False]


def test_html_fields(spark):
    page = (
        "<html><script>var t='</p><p>no';</script><title>A &amp;amp; B</title><!-- <p>x</p> -->"
        '<p class="a">one <b>two</b></p><pre>no</pre><P>three\n four</P><a class=x href="/1">l</a></html>'
    )
    visible = H.visible(F.col("t"))
    row = one(spark, page, H.first_element(visible, "title").alias("title"), H.element_texts(visible, "p").alias("p"),
              H.attribute_values(visible, "a", "href").alias("a"), H.first_element(visible, "h1").alias("h1"))
    assert row.title == "A &amp; B" and row.p == ["one two", "three four"] and row.a == ["/1"] and row.h1 is None


def test_links_from_scripts(spark):
    page = "f('x', 'y'); ({a 감사보고서 \n f( 'r1', 'd2' )})"
    names = ["rcp", "dcm"]
    assert one(spark, page, H.viewer_link(F.col("t"), "u", names, "f", "감사보고서"))[0] == "u?rcp=r1&dcm=d2"
    assert one(spark, "nothing", H.viewer_link(F.col("t"), "u", names, "f", "감사보고서"))[0] is None


def test_analyser_hook(spark):
    df = spark.createDataFrame([("a b",), (None,)], "t string")
    got = [r.w for r in terms.tokenize(df, "t", "w", analyser=str.split).collect()]
    assert got == [["a", "b"], None]


def test_vectors_find_companions(spark):
    sentences = [(["red", "blue", "green"],), (["dog", "cat", "cow"],)] * 200
    tokens = spark.createDataFrame(sentences, "w array<string>")
    vectors = terms.vectors_of(terms.train_vectors(tokens, "w", vector_size=8, iterations=10, partitions=1))
    counts = terms.term_counts(tokens, "w")
    known = terms.most_frequent(vectors, counts, 6)
    near = [r.term for r in terms.nearest_by_cosine(known, "term", "vector", F.lit("red"), 2).collect()]
    assert set(near) == {"blue", "green"}


def test_intake_resumes_and_skips_known(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    links = lambda *urls: spark.createDataFrame([("p", "n", "007", "2019-01-01", "t", u) for u in urls], intake.LINKS)

    def run():
        intake.take_new(intake.read_crawl(spark, source), target, mark).awaitTermination()
        return sorted(r.url for r in intake.stored(spark, target).collect())

    links("a", "b", "b", None).coalesce(1).write.option("header", True).csv(source)
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    links("b", "c").coalesce(1).write.mode("append").option("header", True).csv(source)
    assert run() == ["a", "b", "c"]


def test_long_hosts_do_not_exhaust_the_stack(spark):
    df = spark.createDataFrame([("see http://" + "a" * 100_000 + "/x end",), ("see http://" + "%41b" * 30_000 + " end",)], "t string")
    assert [r.c.split() for r in df.select(T.cleanse(F.col("t")).alias("c")).collect()] == [["see", "x", "end"], ["see", "end"]]


def test_broken_and_quoted_markup(spark):
    page = (
        "<div id='main body'>in <p class=x>first<p>second</p>tail<div><p>third &copy; &#12354; &#x1F600; &nope; &amp;lt;<ul><li>"
        "<a class='k' href='/a?b=1&amp;c'>one</a><li><a href=/b>two</a></ul><p>last"
    )
    row = one(spark, page, H.element_texts(F.col("t"), "p").alias("p"), H.attribute_values(F.col("t"), "a", "href").alias("a"),
              H.selected_text(F.col("t"), "a", "class", "k").alias("k"), H.list_entries(F.col("t")).alias("l"))
    assert row.p == ["first", "second", "third © あ 😀 &nope; &lt;", "last"]
    assert row.a == ["/a?b=1&c", "/b"] and row.k == "one"
    assert [tuple(e) for e in row.l] == [("one", "/a?b=1&c"), ("two", "/b")]
    assert len(one(spark, "<p>x" * 5_000, H.element_texts(F.col("t"), "p").alias("p")).p) == 5_000


def test_whole_elements_by_selector(spark):
    text = lambda page, *by: one(spark, page, H.selected_text(H.visible(F.col("t")), *by))[0]
    assert text("<div id=body>a<div>b</div>c</div>d", "div", "id", "body") == "abc"
    nested = "<div class='x'>0</div><DIV data-a='>' class=\"big art\">a<div><div>b</div></div><divider>c</div>d</div>"
    assert text(nested, "div", "class", "art") == "abc"
    assert text("<p id=a>x<script>var a='</p>';", "p", "id", "a") == "x"
    assert text("<section hidden>a<section>b</section>", "section", "hidden") == "ab"  # open: to the page's end
    assert text("<div id=bodyguard>a</div>", "div", "id", "body") is None and text("x", "div") is None
    assert text("<ul><li>1</ul><article>a&amp;b<!-- </article> --> c</article>", "article") == "a&b c"
    assert text(None, "div") is None and text("", "div") is None
    assert len(text("<div>" + "<div>x</div>" * 20_000 + "</div>y", "div")) == 20_000


def test_list_items_may_start_with_any_element(spark):
    page = "<ul><li><span>1</span><a href=/a>A</a><a href=/b>B</a></li><li>no link<li><ul><li><b><a href='/c'>C</a></b></ul><a href=/d>D</a>"
    got = one(spark, page, H.list_entries(F.col("t")).alias("l")).l
    assert [(e.title, e.link) for e in got] == [("A", "/a"), ("C", "/c")]
