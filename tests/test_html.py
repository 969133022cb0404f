import random
import re
import time

import pytest
from pyspark.sql import functions as F

from strataflow.functions import markup
from strataflow.operators import html_tables

PAGE = """<html><!-- <table class="wikitable"><tr><th>no</th></tr></table> -->
<table class="infobox"><tr><td>x<table class="wikitable"><caption>Other</caption><tr><th>A</th></tr><tr><td>1</td></tr></table></td></tr></table>
<table class="a wikitable b"><caption>CO2&nbsp;things <b>Emissions</b> per capita</caption>
<tr><th>Location[a]</th><th></th><th>V<br>1</th><th>V 1</th></tr>
<tr><th>head</th><td>1</td></tr>
<tr><td>C&ocirc;te&#160;d&#x27;Ivoire [<a>1</a>]</td><td>-</td><td>3</td><td>4</td><td>5</td></tr>
<tr><td>B</td></tr><tr></tr>
<tr><td>N<table><tr><td>in</td></tr></table></td><td>z</td></tr></table></html>"""


@pytest.fixture
def parsed(spark):
    def run(*pages, **options):
        frame = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "page_id int, html string")
        return html_tables.page_tables(frame, **options).orderBy("page_id").collect()

    return run


def test_wanted_table_is_read_by_position(parsed):
    row = parsed(PAGE)[0]
    assert row["headers"] == ["Location", "V 1", "V 1"]
    # An empty header is dropped, so later ones move left; of equal ones the last counts.
    assert row["rows"] == [
        {"Location": "Côte d'Ivoire", "V 1": "3"},
        {"Location": "B", "V 1": None},
        {"Location": "N in", "V 1": "z"},
        {"Location": "in", "V 1": None},
    ]
    assert row["table_html"].startswith('<table class="a wikitable b">') and row["table_html"].endswith("</table>")


def test_first_table_stands_in_when_none_matches(parsed):
    page = '<table class="wikitable"><tr><th>A</th></tr><tr><td>1</td></tr></table><table class=wikitable><tr><th>B</th></tr></table>'
    assert parsed(page)[0]["headers"] == ["A"]


def test_match_by_text_and_by_second_caption(parsed):
    plain = '<table class="wikitable"><tr><th>A</th></tr></table>'
    by_text = '<table class="wikitable"><tr><th>B</th></tr><tr><td>CO2</td><td>per capita</td></tr></table>'
    by_caption = '<table class=\'wikitable\'><caption>Carbon <i>dioxide</i></caption><tr><th>C</th></tr></table>'
    assert [r["headers"] for r in parsed(plain + by_text, plain + by_caption)] == [["B"], ["C"]]


def test_class_must_be_a_whole_word(parsed):
    assert parsed('<table class="wikitable-x"><tr><th>A</th></tr></table>') == []


def test_page_without_table_is_dropped_or_fails(parsed):
    assert parsed("<p>none</p>", '<table class="wikitable"></table>') == []
    with pytest.raises(Exception, match="no usable table"):
        parsed("<p>none</p>", strict=True)


def test_deep_nesting_and_open_elements(values):
    html = "<td>1<td>2<td>3</td></td></td><td>4"
    expected = ["<td>1<td>2<td>3</td></td>", "<td>2<td>3</td>", "<td>3", "<td>4"]
    assert values(markup.elements("v", "td"), [html]) == [expected]
    assert values(markup.elements("v", "td"), ["</td><td>a</td></td><td >b"]) == [["<td>a", "<td >b"]]


def test_tag_names_are_not_prefixes(values):
    assert values(markup.elements("v", "th"), ["<thead><th>a</th></thead>"]) == [["<th>a"]]


def test_visible_text(values):
    fragments = ["<td>1<sup>2</sup></td>", "a <b title='x>y'>b</b>c", "<p don't>x</p>", "1 < 2", None]
    assert values(markup.visible_text("v"), fragments) == ["1 2", "a b c", "x", "1 < 2", None]


def test_hidden_parts(values):
    html = '<style>x</style>a<!-- <b> -->b<script type="t">var a="</p>";</script>c'
    assert values(markup.drop_hidden("v"), [html]) == ["abc"]


def test_entities(values):
    texts = ["&amp;&lt;b&gt; &copy 2020 &foo; &#8211; &#150; AT&T &Aacute;", "&#x1F600;&#0;&#99999999;", "none"]
    assert values(markup.decode_entities("v"), texts) == ["&<b> © 2020 &foo; – – AT&T Á", "😀\ufffd\ufffd", "none"]


def test_long_page_does_not_overflow(parsed):
    body = "".join(f"<tr><td data-x='{'y' * 50}'>n{i}</td><td>{i}</td></tr>" for i in range(5000))
    row = parsed(f'<table class="wikitable"><tr><th>A</th><th>B</th></tr>{body}</table>')[0]
    assert len(row["rows"]) == 5000 and row["rows"][-1] == {"A": "n4999", "B": "4999"}


def test_many_empty_cells_do_not_overflow(parsed):
    body = "<tr>" + "<td></td>" * 20000 + "</tr>"
    row = parsed(f'<table class="wikitable"><tr><th>A</th></tr>{body}</table>')[0]
    assert row["rows"] == [{"A": None}]


def test_element_texts(spark):
    pages = spark.createDataFrame([(1, "<ul><li>a <b>b</b></li><li> </li><li>c[1]</li></ul>")], "page_id int, html string")
    rows = html_tables.element_texts(pages, "li", keep=["page_id"]).orderBy("pos").collect()
    assert [(r["pos"], r["text"]) for r in rows] == [(0, "a b"), (2, "c")]


def test_parse_runs_once_per_page(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    plan = html_tables.page_tables(pages).where(F.size("rows") > 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS _table_of_page") == plan.count("AS _rows_of_page") == plan.count("AS _headers_of_page") == 1


def stack_elements(text, tag):
    """Elements by a plain stack of open tags."""
    marks = [(m.start(), m.group(0)[1] != "/") for m in re.finditer(rf"(?i)<{tag}(?=[\s/>])|</{tag}(?=[\s>])", text)]
    open_, found = [], []
    for at, opens in marks:
        if opens:
            open_.append(at)
        elif open_:
            found.append((open_.pop(), at))
    found += [(at, len(text)) for at in open_]
    return [text[lo:hi] for lo, hi in sorted(found)]


def test_any_order_of_tags_is_matched_as_by_a_stack(values):
    draw = random.Random(3)
    parts = ["<b>", "</b>", "<B x='1'>", "</b >", "<br>", "t", "é", "</i>"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(16))) for _ in range(500)]
    assert values(markup.elements("v", "b"), texts) == [stack_elements(t, "b") for t in texts]


def test_deep_and_long_nests_are_matched(values):
    texts = ["<b>" * 40 + "x" + "</b>" * 35, "<b>" + "<b>y</b>" * 700 + "</b>", "</b>" * 9 + "<b><b></b>" * 300]
    assert values(markup.elements("v", "b"), texts) == [stack_elements(t, "b") for t in texts]


def test_captions_and_text_of_nested_candidates(parsed):
    table = lambda name, inner="", caption="": f'<table class="wikitable">{caption}<tr><th>{name}</th></tr><tr><td>1 {inner}</td></tr></table>'
    caption = "<caption>CO2 x</caption>"
    # The inner one by its caption, although the outer one has that caption in its text too, as its first.
    assert [r["headers"] for r in parsed(table("A", table("B", caption=caption)))] == [["A"]]
    outside = table("A", table("B")) + table("C", table("D", caption=caption))
    assert [r["headers"] for r in parsed(outside)] == [["C"]]
    # A caption of another table within comes first and is not wanted; the whole text is.
    text = table("E", "<table><caption>other</caption><tr><td>co2 per capita</td></tr></table>")
    assert [r["headers"] for r in parsed(table("A", table("B")) + text)] == [["E"]]
    assert [r["headers"] for r in parsed(table("A", table("B")) + table("C"))] == [["A"]]


@pytest.mark.parametrize("shape", ["deep", "wide", "classed"])
def test_time_follows_the_number_of_nested_tags(spark, shape):
    def page(n):
        if shape == "deep":
            return "<table>" * n + "</table>" * n + "<table class=wikitable><tr><th>A</th></tr></table>"
        inner = "<table class=wikitable>" if shape == "classed" else "<table>"
        return "<table class=wikitable><tr><th>A</th></tr><tr><td>" + f"{inner}</table>" * n + "</td></tr></table>"

    def seconds(n):
        frame = spark.createDataFrame([(1, page(n))], "page_id int, html string").cache()
        frame.count()
        start = time.perf_counter()
        assert [r["headers"] for r in html_tables.page_tables(frame).collect()] == [["A"]]
        return time.perf_counter() - start

    seconds(1000)
    small, large = (min(seconds(n) for _ in range(2)) for n in (6000, 12000))
    assert large <= 2.3 * small + 0.2
