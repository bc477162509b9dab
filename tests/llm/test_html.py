import random
from html import escape

import pytest

from loanmeter.llm import html_layout
from loanmeter.llm.html_layout import extract_text, page_text

CASES = {
    "": "",
    "plain  text\n here": "plain text here",
    "<title>t</title><body>b": "b",
    "<p>one<p>two": "one\n\ntwo",
    "<div>one<div>two</div>three</div>": "one\ntwo\nthree",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<h1>Head</h1>text": "Head\n\ntext",
    "<ul><li>a<li>b<ol><li>c</ol></ul>": "- a\n- b\n  1. c",
    "<ol start=9><li>a<li>b</ol>": "9. a\n10. b",
    "<dl><dt>t<dd>d</dl>": "t\n  d",
    "<pre>a  b\n c</pre>": "a  b\n c",
    "<table><tr><th>Name<th>N<tr><td>Apple pie<td>3</table>": "Name       N\nApple pie  3",
    "<table><td>a<td>b</table>": "a  b",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>": "wide cell\na  b",
    "<table><tr><td>x<td><ul><li>p<li>q</ul></table>": "x  - p\n   - q",
    "<p hidden>no</p>yes": "yes",
    "<div style='display: none'>no<p>no</div>yes": "yes",
    "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>": "yes",
    "<script>if (a < b) '</p>'</script>x<style>p{}</style>": "x",
    "<!-- <p>no --> a &lt; b &amp; c&nbsp;&nbsp;d": "a < b & c  d",
    "<b>x<p>y</b>z": "x\n\nyz",
    "</p>a</div></li>b": "ab",
    "1 < 2 <3": "1 < 2 <3",
    "a <b": "a",
    "<textarea> x\n y</textarea>": " x\n y",
    "<p>été \U0001f44d": "été \U0001f44d",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert page_text(html) == CASES[html]


def test_broken_and_deep_pages_end():
    assert page_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "out").split() == ["deep", "out"]
    assert page_text("<table><td>" * 300 + "x") == "x"
    for piece in ('<a x="', "<", "<p><b>", "<!--", "<td>", "</", "<ul><li>", "&amp", "<table>"):
        page_text(piece * 3000)


def test_pages(spark):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<p>a", "u"), (3, "<p>a", "u"), (4, "x " * 200_000, "u")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = [(r.page_id, len(r.text)) for r in extract_text(pages).collect()]
    assert sorted(found) == [(1, 0), (2, 0), (3, 1), (3, 1), (4, 399_999)]
    assert extract_text(pages.limit(0)).count() == 0
    whole = extract_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    assert whole.count() == 250 and whole.where("text rlike '<(p|div|li)>' or length(text) < 20").count() == 0


def test_hidden_text_at_any_depth():
    for depth in (250, 5000):
        page = "<div>" * depth + "<p style='display:none'>secret</p><ul><li>shown</ul>" + "</div>" * depth
        assert html_layout.page_text(page) == "- shown"
    assert html_layout.page_text("<div hidden>" + "<div>" * 5000 + "secret") == ""
    nested = "<table><tr><td>a<td>" * 1000 + "end"
    assert html_layout.page_text(nested).split() == ["a"] * 1000 + ["end"]


def test_added_blanks_are_bounded():
    wide = "<table><tr><td>" + "a" * 40_000 + "<td>b" + "<tr><td>c<td>d" * 1000
    found = html_layout.page_text(wide).split("\n")
    assert found[0] == "a" * 40_000 + "  b" and set(found[1:]) == {"c" + " " * html_layout.MOST_PAD + "d"}
    pages = [
        wide,
        "<blockquote>" * 2000 + "x<br>" * 2000,
        "<ul><li>" * 2000 + "x<br>" * 2000,
        "<table><tr>" + "<td>" + ("<td>" + "z" * 40) * 1000 + "<tr><td colspan=1000>a<td>b" * 2000,
        "<table><tr><td>" + "q" * 40 + "<td>" + ("<table><tr><td>" + "q" * 40 + "<td>") * 50 + "y<br>" * 500,
        "<table><tr>" + "<td colspan=1000 rowspan=9>x" * 5000,
    ]
    for page in pages:
        assert len(html_layout.page_text(page)) <= (html_layout.MOST_PAD + 2) * len(page) / 4


def plain_layout(blocks):
    """Paragraphs, nested lists and tables, laid out by their own rules: nothing is parsed."""
    out = []
    for kind, content in blocks:
        if kind == "p":
            lines = [" ".join(content)]
        elif kind == "ul":
            lines = ["- " + " ".join(x) for x in content]
        elif kind == "ol":
            lines = [f"{i + 1}. " + " ".join(x) for i, x in enumerate(content)]
        else:
            widths = [max(len(row[c]) for row in content) for c in range(len(content[0]))]
            lines = ["  ".join(x.ljust(w) for x, w in zip(row, widths)).rstrip() for row in content]
        out.append("\n".join(lines))
    return "\n\n".join(out)


def test_simple_pages_against_an_independent_layout():
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abc&<é") for _ in range(draw.randint(1, 6)))
    for _ in range(200):
        blocks = []
        for _ in range(draw.randint(1, 5)):
            kind = draw.choice(["p", "ul", "ol", "table"])
            some = [[word() for _ in range(draw.randint(1, 4))] for _ in range(draw.randint(1, 4))]
            if kind == "table":
                some = [[word() for _ in range(3)] for _ in some]
            blocks.append((kind, some[0] if kind == "p" else some))
        page = ""
        for kind, content in blocks:
            if kind == "p":
                page += "<p>" + "\n ".join(map(escape, content))
            elif kind == "table":
                page += "<p></p><table>" + "".join("<tr>" + "".join(f"<td> {escape(x)}" for x in row) for row in content) + "</table>"
            else:
                page += f"<{kind}>" + "".join("<li>" + " \t".join(map(escape, x)) for x in content) + f"</{kind}>"
        assert html_layout.page_text(page) == plain_layout(blocks), page
