import html as html_lib
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from skillgauge.functions.dates import posted_date
from skillgauge.functions.ids import stable_id
from skillgauge.functions.text import newline_normalised, strip, with_html_text

PAGES = "/root/testdata/sf0.001/pages.parquet"


class Model(HTMLParser):
    """Text nodes outside script, style and template, one per gap in markup."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.text, self.code = [], "", 0

    def cut(self):
        if not self.code and html_lib.unescape(self.text).strip():
            self.nodes.append(html_lib.unescape(self.text).strip())
        self.text = ""

    def handle_starttag(self, tag, attrs):
        self.cut()
        self.code += tag in ("script", "style", "template")

    def handle_endtag(self, tag):
        self.cut()
        self.code -= tag in ("script", "style", "template") and self.code > 0

    def handle_data(self, data):
        self.text += data

    def handle_entityref(self, name):
        self.text += f"&{name};"

    def handle_charref(self, name):
        self.text += f"&#{name};"

    def handle_comment(self, data):
        self.cut()

    handle_decl = handle_pi = unknown_decl = handle_comment


def model_text(markup):
    parser = Model()
    parser.feed(markup)
    parser.close()
    parser.cut()
    return " ".join(parser.nodes)


def texts(frame, values, column):
    df = frame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def html_texts(frame, values, separator=" "):
    df = frame([(i, v) for i, v in enumerate(values)], "i int, v string")
    df = with_html_text(df, "v", "t", separator)
    assert df.columns == ["i", "v", "t"]
    return [r.t for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    "markup, text",
    [
        (None, None),
        ("", None),
        ("<p></p>", ""),
        ("a<b>b</b>c", "a b c"),
        ("<p> a </p>\n<p> b </p>", "a b"),
        ("x &lt;b&gt; y", "x <b> y"),
        ("&amp;lt;", "&lt;"),
        ("&eacute;&#233;&#xe9;&nbsp;", "ééé"),
        ("a<!-- <p>c</p> -->b", "a b"),
        ('a<script>var t="</p>";</script>b<style>p{}</style>', "a b"),
        ("a<template><b>t</b></template>b", "a b"),
        ('<a title="x > y" href=\'>\'>z</a>', "z"),
        ("<a title=it's>z</a> it's", "z it's"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<!DOCTYPE html><p>a", "a"),
        ("a\u0000b", "ab"),
        ("l1\nl2", "l1\nl2"),
        ("AT&T &copy 2", "AT&T © 2"),
    ],
)
def test_html_to_text(frame, markup, text):
    assert html_texts(frame, [markup]) == [text]


def test_html_to_text_without_separator(frame):
    assert html_texts(frame, ["<b> a </b> b"], "") == ["ab"]


def test_html_to_text_equals_a_parser_on_whole_pages(spark):
    pages = spark.read.parquet(PAGES).select("html")
    rows = with_html_text(pages, "html", "text").collect()
    assert len(rows) == 50
    for markup, text in rows:
        assert text == model_text(markup)


def test_html_to_text_equals_a_parser_on_random_markup(frame):
    rng = random.Random(3)
    atoms = ["<p>", "</p>", "<b class='x'>", "</b>", "<br/>", "&amp;", "&eacute;", " ",
             "x", "ü", " ", "\n", "<!-- c -->", "<script>s<b></script>", "&#8364;",
             '<a href="?a=1&b=2">', "</a>", "5 < 6", "&lt;i&gt;"]
    markups = ["".join(rng.choices(atoms, k=rng.randint(1, 12))) for _ in range(400)]
    assert html_texts(frame, markups) == [model_text(m) for m in markups]


def test_references_equal_pythons(frame):
    rng = random.Random(4)
    atoms = ["&", "&amp", "&amp;", "&lt;", "&#39;", "&#39", "&notit;", "&copy", "&middot;", "&#x20ac;", "&#0;", "&#xD800;",
             "&#99999999;", "&;", "&#;", "&#x;", "&foo bar", "&nbspx", "lt;", "x" * 40, " ", ";", "#", "\u00fc", "\U0001f600"]
    texts_ = ["a" + "".join(rng.choices(atoms, k=rng.randint(1, 9))) + "b" for _ in range(500)]
    assert html_texts(frame, texts_) == [html_lib.unescape(t) for t in texts_]


def test_only_references_go_to_python_and_once(frame):
    pages = with_html_text(frame([("a &copy; b",)], "v string"), "v", "t")
    words = pages.select(F.explode(F.split("t", " ")).alias("w"))
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "_unescape(regexp_extract_all(" in plan
    assert [r.w for r in words.collect()] == ["a", "\u00a9", "b"]


def test_long_attributes_do_not_overflow(frame):
    markup = f"<a title=\"{'x' * 200_000}\" {'y' * 200_000}>t</a><!--{'z' * 200_000}-->"
    assert html_texts(frame, [markup]) == ["t"]


def test_strip_is_pythons(frame):
    values = [c + "a" + c for c in (" ", "\t", "\x1c", "\x85", "　", " ", "_")]
    assert texts(frame, values, strip) == [v.strip() for v in values]


def test_newlines(frame):
    assert texts(frame, ["a\r\nb\rc\nd"], newline_normalised) == ["a\nb\nc\nd"]


@pytest.mark.parametrize(
    "text, date",
    [
        ("2026-07-30", "2026-07-30"),
        ("2026-07-30T23:00:00Z", "2026-07-30"),
        ("2026-07-30T23:00:00-03:00", "2026-07-30"),
        ("2026-07-30 23:00:00.123456+00:00", "2026-07-30"),
        ("2026-7-3", "2026-07-03"),
        ("20260730", "2026-07-30"),
        ("20260730T1200", "2026-07-30"),
        ("2026-W31-4", "2026-07-30"),
        ("2026-W31", "2026-07-27"),
        ("2026W314", "2026-07-30"),
        ("2021-W53", None),
        ("2026-02-30", None),
        ("2026-07-30 soon", None),
        ("2026", None),
        ("30.07.2026", None),
        ("", None),
        (None, None),
    ],
)
def test_posted_date(frame, text, date):
    got = texts(frame, [text], lambda c: posted_date(c).cast("string"))
    assert got == [date]


def test_stable_id_tells_lists_apart(frame):
    df = frame([("ab", "c"), ("a", "bc"), ("abc", ""), ("abc", None)], "a string, b string")
    ids = [r[0] for r in df.select(stable_id(F.col("a"), F.col("b"))).collect()]
    assert len(set(ids)) == 4
    assert ids == [r[0] for r in df.select(stable_id(F.col("a"), F.col("b"))).collect()]
