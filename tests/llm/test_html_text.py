import re
import time
from html import escape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rolepulse.llm.html_text import visible_text

CASES = {
    "<p>One<p>two  \n three<div>four</div>five": "One\n\ntwo three\n\nfour\nfive",
    "<html><head><title>T</title><style>p{}</style><body><h1>Head</h1>text": "Head\n\ntext",
    "<title>t</title><p>no body": "no body",
    "a<b>b</b> <i> c</i>d": "ab cd",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>end": "- a\n- b\n  3. x\n  4. y\n- c\n\nend",
    "<ul><li><p>a</p><p>b</p></ul>": "- a\n\n  b",
    "<ul><li></li><li>b</ul>": "- b",
    "<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>x</table>z": "Name       N\nlong name  1\nx\n\nz",
    "<table><caption>C</caption><tbody><tr><td><p>a</p><p>b</p><td>c<tbody><tr><td>d</table>": "C\na b  c\nd",
    "<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>": "in  ner  out",
    "<pre>a\n  b\n\nc</pre>d": "a\n  b\n\nc\n\nd",
    "a<br>b<br/>c": "a\nb\nc",
    "a<span hidden>b</span><span style='display: none'>c</span><script>d</script><!-- e --><noscript>f</noscript>g": "ag",
    "<div style='visibility:hidden'>a<b style='visibility:visible'>b</b></div>": "b",
    "<img alt='pic'><input type=hidden value=x><input value=v>": "picv",
    "&amp;&lt;p&gt; &uuml;&#8364;": "&<p> ü€",
    "</p></div>x</td>": "x",
    "<blockquote>q<blockquote>r</blockquote></blockquote>": "  q\n\n    r",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<select><option>a<option>b</select>": "a\nb",
    "": "", " \n ": "", "<script>x": "",
    "<head><title>T</title>Hello <b>world</b><br>more<p>x": "Hello world\nmore\n\nx",
    "<head><title>T</title> <span>a</span> b<meta charset=x>c": "a bc",
    "<head> <script>s</script> </head> a": "a",
    "a<svg><defs><text>no</text></defs><title>no</title><text>one</text><text x=1>two</text></svg>b": "a\none\ntwo\nb",
    "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>": "x=1",
    "<table><tr><td colspan=2>wide cell here<td>c<tr><td>a<td>b<td>d</table>": "wide cell here  c\na  b            d",
    "<table><tr><td colspan=2>w<td>c<tr><td>aaaa<td>bbbb<td>d</table>": "w           c\naaaa  bbbb  d",
    "<table><tr><td rowspan=2>r<td>a<td>x<tr><td>b<td>y<tr><td>c<td>d<td>z</table>": "r  a  x\n   b  y\nc  d  z",
    "<table><tr><td colspan=99999999>a<td>b<tr><td rowspan=0>c<td colspan=x>d</table>": None,
    "a<p>b<!-- open <p>c": "a\n\nb",
    "a<!-- closed -->b<!doctype": "ab",
    "<script>var s = '<!--';</script>a": "a",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert visible_text(html) == CASES[html] or CASES[html] is None and re.sub(r"\s+", " ", visible_text(html)) == "a b c d"


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.text("ab <&é\n", max_size=6).map(lambda t: (escape(t), t)),
                    lambda c: st.tuples(st.sampled_from("p div span b ul li table tr td h1 ol section".split()), st.lists(c, max_size=4)).map(
                        lambda x: (f"<{x[0]}>" + "".join(a for a, _ in x[1]) + f"</{x[0]}>", "".join(b for _, b in x[1]))), max_leaves=25))
def test_every_visible_letter_is_kept(case):
    html, text = case
    letters = lambda t: sorted(re.sub(r"[^ab<&é]", "", t))
    assert letters(visible_text(html)) == letters(text)


def test_deep_and_long_pages():
    began = time.time()
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<p>y" * 50_000).count("y") == 50_000
    assert visible_text("<b><li>" * 5_000 + "z").endswith("z")
    assert visible_text("</b>" * 50_000 + "<" * 50_000 + "a").endswith("a")
    assert time.time() - began < 60


def test_rows(spark):
    from rolepulse.llm.html_text import extracted

    rows = [(1, "<p>a"), (1, "<p>a"), (None, "b"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit("clash"), "n_chars": F.lit("clash")})
    assert sorted(map(tuple, extracted(df).collect()), key=str) == sorted([(1, "a", 1), (1, "a", 1), (None, "b", 1), (2, "", 0), (3, "", 0)], key=str)
    assert extracted(df.limit(0)).isEmpty()
