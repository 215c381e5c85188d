"""Layout cases, and the words of given pages against a plain parser."""

import re
from html.parser import HTMLParser

import pytest

from ledgermill.llm.html_text import extract_text
from ledgermill.llm.render import visible_text

CASES = {
    "implied ends": ("<p>one<p>two<ul><li>a<li>b</ul>", "one\n\ntwo\n\n- a\n- b"),
    "inline and spaces": ("a <b>b</b>c\n  <i> d</i> e", "a bc d e"),
    "blocks": ("<div>a<div>b</div>c</div><section>d</section>", "a\nb\nc\nd"),
    "breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "entities": ("&lt;p&gt; &amp;amp; &eacute;&#233; &nope; < 3", "<p> &amp; éé &nope; < 3"),
    "numbers": ("<ol start=9><li>a<li>b<ul><li>c</ul><li value=20>d<li>e</ol>", "9. a\n10. b\n  - c\n20. d\n21. e"),
    "head": ("<head><title>t</title><meta x><base></head>a<script>no</script><noscript>no</noscript>", "a"),
    "hidden": ("<p hidden>no</p><p style='display: none'>no<p style='visibility:hidden'>no <b style='visibility:visible'>yes</b></p>", "yes"),
    "sheet": ("<style>.x, #y{color:red;display:none} b{font:x}</style><p class='a X'>no<p id=y>no<p class=z>yes", "yes"),
    "print rule": ("<style>@media print { .menu { display: none } } .x{display:none}</style><p class=menu>yes<p class=x>no", "yes"),
    "print sheet": ("<style media=print>p{display:none}</style><p>yes", "yes"),
    "narrow screen": ("<style>@media (max-width: 600px){.a{display:none}}@media screen and (min-width:40em){.b{display:none}}@media(width<=600px){.c{display:none}}</style><p class=a>a<p class=b>b<p class=c>c", "a\n\nc"),
    "nested media": ("<style>@media screen{@media print{p{display:none}} b{display:none}}</style><p>yes <b>no</b>", "yes"),
    "later rule": ("<style>.x{display:none}.y{display:none}</style><style>.x{display:block}</style><p class=x>yes<p class=y>no", "yes"),
    "stronger rule": ("<style>#i{display:none}.x{display:block}.z{display:none!important}p{display:none}</style><p class=x>yes<p class=x id=i>no<p class=z style='display:block'>no<p>no", "yes"),
    "inline override": ("<style>.x{display:none}</style><p class=x style='display:block'>yes<p class=x style='color:red'>no<p hidden style='display:flex'>yes", "yes\n\nyes"),
    "details": ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details><dialog>no</dialog>", "s\nt\nyes"),
    "preformatted": ("<pre>\n a\n   b\tc\n</pre>x", " a\n   b    c\n\nx"),
    "table": (
        "<table><caption>cap</caption><tr><th>Name<th>Sum<tr><td>Anna Maria<td>1<td>x<tr><td>漢字<td>22</table>",
        "cap\nName        Sum\nAnna Maria  1    x\n漢字        22",
    ),
    "spans": (
        "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td colspan=2>wide one<td>f</table>",
        "a  b  c\n   d  e\nwide one  f",
    ),
    "cells of lines": ("<table><tr><td>a<br>b<td><ul><li>x<li>y</ul></table>", "a  - x\nb  - y"),
    "nested table": ("<table><tr><td>l<td><table><tr><td>1<td>2</table></table>", "l  1  2"),
    "quotes in tags": ("<a title='>' href=\"x>y\">a</a><a title='b>c", "ac"),
    "doubled quote": ("<a href=\"x\"\">one</a> two <b title=\"y\">three</b> \"four\" five", "one two three \"four\" five"),
    "apostrophe in a value": ("<a title=Bob's>one</a> it's <b>two</b> <i title='z'>three</i>", "one it's two three"),
    "quotes elsewhere": ("<a 'x>one</a \"> <b =\"y>two</b> it's <i a = '>'>\"three\"</i>", "one two it's \"three\""),
    "comments": ("a<!-- <p> -->b<!doctype x>c<?php ?>d<!-- open", "abcd"),
    "unknown and stray": ("<foo>a</bar></p>b</foo></div>", "a\n\nb"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    html, expected = CASES[name]
    assert visible_text(html)[1] == expected


def test_deep_and_wide_pages_end():
    assert visible_text("<div><b><li>" * 30_000 + "deep")[1].endswith("deep")
    assert "x" in visible_text("<table><tr><td>" * 3000 + "x")[1]
    assert visible_text("<a '" * 30_000 + ">")[1] == ""
    assert len(visible_text("<p>" + "word " * 200_000)[1]) == 999_999


class Plain(HTMLParser):
    skip = 0

    def __init__(self):
        super().__init__()
        self.words = []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.words += data.split()


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for row in rows:
        plain = Plain()
        plain.feed(row.html)
        text = got[row.page_id].text
        shown = [w for w in re.sub(r"(?m)^ *- ", "", text).split()]
        assert "".join(shown) == "".join(plain.words)
        assert "\n\n" in text and got[row.page_id].n_chars == len(text)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>a"), (3, "<p>b"), (3, "<p>b"), (4, "<td>" * 100_000)]
    frame = spark.createDataFrame([(i, "u", h, "t", 1) for i, h in rows], "page_id long, url string, html string, title string, text int")
    got = sorted((str(r.page_id), r.title, r.text) for r in extract_text(frame).collect())
    assert got == [("1", "", ""), ("2", "", ""), ("3", "", "b"), ("3", "", "b"), ("4", "", ""), ("None", "", "a")]
    assert extract_text(frame.limit(0)).count() == 0
