"""HTML text: layout, implied tags and visibility on hand-written pages."""

from __future__ import annotations

import html
import random
import time

import pytest
from pyspark.sql import functions as F

from faultline.llm.html_text import RAW, _placed, extracted, page_text, tokens

PAGES = {
    "<p>one<p>two  <b>b</b>\n three": "one\n\ntwo b three",
    "<title>t</title><h1>H</h1>text<br>next<div>d</div>e": "H\n\ntext\nnext\nd\ne",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=3><li>x<li>y<ol><li>z</ol></ol>": "3. x\n4. y\n   1. z",
    "<table><caption>cap</caption><tr><th>a<th>long head<tr><td>wide cell<td>1<td>2</table>":
        "cap\na          long head\nwide cell  1          2",
    "<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3</table>": "ab     c\n1   2  3",
    "a<script>if (x < '</p>') y</script>b<style>p{}</style>c": "abc",
    "<div hidden>no</div><p style='color:red; display : none'>no<p>yes<template>no</template>": "yes",
    "x<!-- no <p> -->y<!--unended": "xy",
    "&lt;a&gt; &amp; &copy; &am &#233;": "<a> & © &am é",
    "<pre>\n  k\n   l </pre>m": "  k\n   l \n\nm",
    "<dl><dt>t<dd>d<dt>u<dd>v</dl>": "t\n  d\nu\n  v",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "a</p></div>b<unknown>c": "abc",
    "<a href=\"x>y\">link</a> <img alt='pic'>": "link pic",
    "cut <b": "cut",
    "": "",
    "  \n ": "",
    "<ol start='--5'><li>x": "1. x",
    f"<table><tr><td colspan={'9' * 5000}>a<td>b<tr><td>c": "a  b\nc",
    "<p>one</p><a href=it's>Visible</a><p>two words</p>": "one\n\nVisible\n\ntwo words",
    "<div don't>kept</div><p>after</p>": "kept\n\nafter",
    "a<!-- x --!>b<!-->c<!--->d": "abcd",
    "<a title='never closed>x</a> y": "x y",
    "<a title= \"a>b\" x=1>y<b =z=1>w": "yw",
    "<table><tr><td rowspan=2>tall<td>a<tr><td>b<tr><td>x<td>y</table>": "tall  a\n      b\nx     y",
    "<table><tbody><tr><td rowspan=9>p<td>q</tbody><tbody><tr><td>r<td>s</table>": "p  q\nr  s",
    "<table><tr><td>1<td colspan=3>wide<td>2<tr><td>a<td>b<td>c<td>d<td>e</table>": "1  wide        2\na  b     c  d  e",
    "<ol reversed><li>a<li>b<li value=9>c<li>d</ol>": "4. a\n3. b\n9. c\n8. d",
    "<ol><li value=7>a<li>b<li value=x>c</ol>": "7. a\n8. b\n9. c",
    "<br/>x<div class=a/>y": "\nx\ny",
}


@pytest.mark.parametrize("page", PAGES)
def test_layout(page):
    assert page_text(page) == PAGES[page]


def test_all_words_survive_any_tags():
    rng = random.Random(6)
    tags = ["p", "div", "li", "ul", "ol", "table", "tr", "td", "b", "h2", "pre", "blockquote", "dd", "br", "tbody", "x"]
    for _ in range(600):
        words, page = [], ""
        for k in range(rng.randint(0, 40)):
            roll = rng.random()
            if roll < 0.4:
                words.append(f"w{k}")
                page += f" w{k} "
            else:
                page += f"<{'/' if roll > 0.75 else ''}{rng.choice(tags)}>"
        assert sorted(page_text(page).replace("- ", " ").split()) >= [] and set(words) <= set(page_text(page).split())


def slow_attributes(page, at):
    """Character by character: (attributes, closes itself, place behind the tag)."""
    attrs, slash = {}, False
    while at < len(page):
        c = page[at]
        if c == ">":
            return attrs, slash, at + 1
        if c == "/" or c.isspace():
            slash = c == "/"
            at += 1
            continue
        name, slash = c, False
        at += 1
        while at < len(page) and not page[at].isspace() and page[at] not in "/>=":
            name += page[at]
            at += 1
        ahead = at
        while ahead < len(page) and page[ahead].isspace():
            ahead += 1
        value = ""
        if ahead < len(page) and page[ahead] == "=":
            at = ahead + 1
            while at < len(page) and page[at].isspace():
                at += 1
            if at < len(page) and page[at] in "\"'" and page.find(page[at], at + 1) >= 0:
                end = page.index(page[at], at + 1)
                value, at = page[at + 1 : end], end + 1
            else:
                while at < len(page) and not page[at].isspace() and page[at] != ">":
                    value += page[at]
                    at += 1
        attrs.setdefault(name.lower(), html.unescape(value))
    return attrs, False, at


def slow_tokens(page):
    at = 0
    while at < len(page):
        letter = lambda i: i < len(page) and page[i].isascii() and page[i].isalpha()
        if page.startswith("<!--", at):
            ends = [(page.find(e, at + 4), len(e)) for e in ("-->", "--!>")]
            ends = [(i, n) for i, n in ends if i >= 0]
            if page.startswith("<!-->", at) or page.startswith("<!--->", at):
                at = page.index(">", at) + 1
            else:
                at = sum(min(ends)) if ends else len(page)
        elif page[at] == "<" and at + 1 < len(page) and page[at + 1] in "!?":
            at = page.find(">", at) + 1 or len(page)
        elif page[at] == "<" and (letter(at + 1) or page.startswith("</", at) and letter(at + 2)):
            closing = page[at + 1] == "/"
            at += 1 + closing
            name = ""
            while at < len(page) and not page[at].isspace() and page[at] not in "/>":
                name += page[at].lower()
                at += 1
            if closing:
                at = page.find(">", at) + 1 or len(page)
                yield "end", name
                continue
            attrs, slash, at = slow_attributes(page, at)
            yield "start", name, attrs, slash, None
        else:
            end = page.find("<", at + 1)
            if page[at] == "<":
                end = at + 1
            end = len(page) if end < 0 else end
            yield "text", html.unescape(page[at:end])
            at = end


def test_tokens_equal_a_slow_parser():
    rng = random.Random(2)
    pieces = ["<", ">", "/", "=", "'", '"', " ", "\n", "a", "b1", "<p ", "</p", "<div", "href=", "&lt;", "--", "!", "<!--", "-->", "--!>", "?",
              "x='1>2'", 'y="q"', "é"]
    for _ in range(20_000):
        page = "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        assert list(tokens(page)) == list(slow_tokens(page)), page


def test_words_survive_tags_with_attributes():
    rng = random.Random(8)
    tags = [tag for tag in ["p", "div", "li", "ul", "ol", "table", "tr", "td", "b", "h2", "blockquote", "br", "tbody"] if tag not in RAW]
    attrs = ["", " a", " a='x>y'", ' b="<p>"', " c=d", " don't", " rowspan=3", " colspan=4", " rowspan=0", " start=--1", " value=5", " ="]
    for _ in range(600):
        words, page = [], ""
        for k in range(rng.randint(0, 40)):
            if rng.random() < 0.4:
                words.append(f"w{k}")
                page += f" w{k} "
            else:
                page += f"<{rng.choice(tags)}{rng.choice(attrs)}{rng.choice(attrs)}>" if rng.random() < 0.7 else f"</{rng.choice(tags)}>"
        assert set(words) <= set(page_text(page).split()), page


def slow_places(rows, group_ends):
    grid, out = set(), []
    for r, row in enumerate(rows):
        column, found = 0, []
        for across, down, lines in row:
            while (r, column) in grid:
                column += 1
            found.append((column, lines))
            end = min(r + down, group_ends[r]) if down else group_ends[r]
            grid |= {(i, column + j) for i in range(r, max(end, r + 1)) for j in range(across)}
            column += across
        out.append(found)
    return out


def test_spans_equal_a_grid():
    rng = random.Random(5)
    for _ in range(800):
        rows = [[(rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 2, 3, 0, 9]), ["x"]) for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(1, 7))]
        ends, cuts = [], [*sorted(rng.sample(range(1, len(rows) + 1), rng.randint(0, len(rows) // 2))), len(rows)]
        for r in range(len(rows)):
            ends.append(next(c for c in cuts if c > r))
        assert _placed(rows, ends) == slow_places(rows, ends), (rows, ends)


def test_wide_and_tall_spans_take_bounded_time():
    start = time.process_time()
    assert page_text("<table>" + "<tr><td colspan=1000 rowspan=65534>w" * 20_000).count("w") == 20_000
    assert page_text("<table><tr>" + "<td colspan=1000>w" * 20_000).count("w") == 20_000
    assert page_text("<a x='" * 30_000 + ">w</a>").endswith("w")
    assert time.process_time() - start < 30


def test_deep_and_long_pages():
    assert page_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert page_text("<ul><li>" * 3000 + "deep").endswith("deep")
    assert len(page_text("<p>w " * 100_000).split()) == 100_000


def test_extracted(spark):
    rows = [(1, "<p>a<p>b"), (2, None), (None, ""), (1, "<p>a<p>b")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("mine"))
    got = sorted((tuple(r) for r in extracted(pages).collect()), key=str)
    assert got == sorted([(1, "a\n\nb", 4, 3), (2, None, 0, 0), (None, "", 0, 0), (1, "a\n\nb", 4, 3)], key=str)
    assert extracted(pages.limit(0)).count() == 0
