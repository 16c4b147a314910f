import re
import time

import pytest

from ebbline.llm.render import build, extract, render

CASES = [
    ("<p>one<p>two", "one\n\ntwo"), ("a<br>b<br><br>c", "a\nb\n\nc"), ("<div>a</div><div>b <b>c</b>d</div>", "a\nb cd"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>", "- a\n- b\n  3. c\n  4. d"),
    ("<table><tr><th>k<th>value<tr><td>long cell<td>2</table>", "k          value\nlong cell  2"),
    ("<table><td colspan=2>wide<tr><td>a<td>b</table>x", "wide\na  b\n\nx"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"), ("a<!-- x --><!doctype html>b", "ab"), ("&copy;&#65;&middot;&lt;p&gt;", "©A·<p>"),
    ("<head><title>t</title><style>p{}</style></head>x<script>var a='</p>'</script>y", "xy"),
    ("a<span hidden>b</span><span style='color:red; display : none'>c</span><i style='visibility:hidden'>d</i>e", "ae"),
    ("<p a='<b>'>x</p><p b=\"'>\">y", "x\n\ny"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("x</p>y", "x\n\ny"), ("a < b <c", "a < b"),
    ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"), ("", ""), (None, ""), ("<textarea> a <b></textarea>", "a <b>"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_layout(source, want):
    assert render(source) == want


def test_broken_and_deep_pages_end_soon():
    for part in ("<", "<div>", "<table>", "<p ", '<a b="', "</p>", "<!--", "<li>", "<td>", "<ul>", "<table><tr>", "<b>"):
        start = time.time()
        render(part * 5_000 + "x")
        assert time.time() - start < 20


def test_every_visible_word_stays(spark):
    """Against a plain reading: hidden elements out, tags out, entities decoded."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract(pages).join(pages, "page_id").collect():
        seen = re.sub(r"(?s)<(script|style|head|title)\b.*?</\1>|<!--.*?-->|<![^>]*>", " ", r.html)
        words = html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", " ", seen)).split()
        got = re.sub(r"(?m)^ *(?:- |\d+\. )", "", r.text).split()
        assert sorted("".join(got)) == sorted("".join(words))
    assert extract(pages.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, 3), (1, "", 3), (None, "<p>x", 3)], "page_id bigint, html string, text int")
    assert [r.text for r in extract(odd).collect()] == ["", "", "x"]


def test_tree_implies_rows():
    table = build("<table><td>x").children[0]
    assert [c.tag for c in table.children] == ["tr"]


def test_visibility_is_inherited_and_display_is_not():
    assert render("<i style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</i>d") == "bd"
    assert render("<div style='visibility:hidden'><ul><li>a<li style='visibility: visible'>b</ul></div>c") == "- b\n\nc"
    assert render("<div style='display:none'>a<b style='display:block;visibility:visible'>b</b></div>c") == "c"
    assert render("<p style='display:none;display:block'>a<p hidden>b<p hidden style='display:block'>c") == "a\n\nc"


def test_cells_span_rows_and_columns():
    assert render("<table><tr><td rowspan=2>A<td>b<tr><td>c</table>") == "A  b\n   c"
    assert render("<table><tr><td>a<td rowspan=3>B<td>c<tr><td>d<td>e<tr><td>f<td>g</table>") == "a  B  c\nd     e\nf     g"
    assert render("<table><tr><td rowspan=0>A<td>b<tr><td>c<tbody><tr><td>d<td>e</table>") == "A  b\n   c\nd  e"
    assert render("<table><tr><td colspan=3>wide<td>z<tr><td>a<td>b<td>c<td>d</table>") == "wide     z\na  b  c  d"


def test_long_cells_stay_aligned():
    long = "word " * 30
    assert render(f"<table><tr><td>{long}<td>x<tr><td>b<td>y</table>") == f"{long.strip()}  x\nb{' ' * 150}y"


def test_hostile_tags_take_linear_time():
    start = time.time()
    for n in (200_000,):
        for tag in ("<a " + "/" * n + "=", "<a " + "= " * n, "<a " + " " * n + "b", "<a x" + " " * n + ">", "<a b='" + '"' * n):
            render(tag)
    # A wide cell next to many rows, and cells that span all columns: padding is bounded.
    wide = render(f"<table><tr><td>{'y' * 1_000_000}<td>x{'<tr><td>a<td>b' * 20_000}</table>")
    assert len(wide) < 3_000_000 and wide.count("a  b") == 20_000
    spans = render("<table>" + "<tr>" + "<td colspan=1000 rowspan=9>x" * 2_000 + "<tr>" + "<td>y" * 2_000)
    assert spans.count("x") == spans.count("y") == 2_000
    assert time.time() - start < 20


def test_repeated_rows_come_out_alike(spark):
    rows = [(1, "<p>x<table><td>a<td>b"), (1, "<p>x<table><td>a<td>b"), (2, None)]
    got = extract(spark.createDataFrame(rows, "page_id bigint, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(1, "x\n\na  b"), (1, "x\n\na  b"), (2, "")]
