import json

import pytest
from pyspark.sql import functions as F

from skillgauge.operators.dom import parse_listing, parse_selectors
from skillgauge.operators.extract import parse_postings, source_id, split_errors


def page(block):
    return f'<html><script type="application/ld+json">{block}</script><p>x</p></html>'


FULL = {
    "title": "Data Engineer",
    "description": "<p>Python &amp; SQL</p><ul><li>dbt</li></ul>",
    "datePosted": "2026-07-30T23:00:00Z",
    "hiringOrganization": {"name": "N"},
    "jobLocation": {"address": {"addressCountry": "AR"}},
}


def parse(frame, *pages):
    rows = [(f"job_{i}.html", html) for i, html in enumerate(pages)]
    df = parse_postings(frame(rows, "file_name string, html string"))
    return sorted(df.collect(), key=lambda r: r.file_name)


def changed(**fields):
    return page(json.dumps({**FULL, **fields}))


def test_full_record(frame):
    (row,) = parse(frame, page(json.dumps(FULL)))
    assert row.asDict() == {
        "file_name": "job_0.html",
        "source": "indeed",
        "job_source_id": "0",
        "country": "AR",
        "job_title": "Data Engineer",
        "company_name": "N",
        "job_url": "https://ar.indeed.com/viewjob?jk=0",
        "job_description": "Python & SQL dbt",
        "posted_date": "2026-07-30",
        "error_reason": None,
    }


@pytest.mark.parametrize(
    "html, reason",
    [
        (None, "bad_encoding"),
        ("<html>none</html>", "no_json_ld"),
        ('<script type="application/ld+json"> {} </script>', "no_json_ld"),
        (page("{'a':1}"), "bad_json"),
        (page('{"a":1,}'), "bad_json"),
        (changed(jobLocation=[]), "bad_shape"),
        (changed(jobLocation=None), "bad_shape"),
        (changed(jobLocation={"address": "AR"}), "bad_shape"),
        (changed(jobLocation={"address": {"addressCountry": 5}}), "bad_shape"),
        (changed(hiringOrganization=None), "bad_shape"),
        (changed(hiringOrganization="N"), "bad_shape"),
        (changed(title=["a"]), "bad_shape"),
        (changed(description={"a": 1}), "bad_shape"),
        (changed(datePosted=20260730), "bad_date"),
    ],
)
def test_broken_pages_keep_only_their_name(frame, html, reason):
    (row,) = parse(frame, html)
    fields = row.asDict()
    assert fields.pop("error_reason") == reason
    assert fields.pop("file_name") == "job_0.html"
    assert set(fields.values()) == {None}


@pytest.mark.parametrize(
    "html, field, value",
    [
        (changed(jobLocation={}), "country", None),
        (changed(jobLocation={}), "job_url", "https://indeed.com/viewjob?jk=0"),
        (
            changed(jobLocation={"address": {"addressCountry": ""}}),
            "job_url",
            "https://indeed.com/viewjob?jk=0",
        ),
        (changed(hiringOrganization={}), "company_name", None),
        (changed(title=3), "job_title", "3"),
        (changed(title=None), "job_title", None),
        (changed(description=None), "job_description", None),
        (changed(description=""), "job_description", None),
        (changed(description="<br>"), "job_description", ""),
        (changed(datePosted="soon"), "posted_date", "soon"),
        (changed(datePosted=""), "posted_date", None),
        (page("{}"), "posted_date", None),
        (page('{"title":"a"}\n{"title":"b"}').replace("\n", "</script>"), "job_title", "a"),
        (page('{"title":"a","title":"b"}'), "job_title", "b"),
        (page('{\n"title":"a"\n}'), "job_title", "a"),
    ],
)
def test_lenient_fields(frame, html, field, value):
    (row,) = parse(frame, html)
    assert row.error_reason is None
    assert row[field] == value


@pytest.mark.parametrize(
    "name, expected",
    [
        ("job_2e13.html", "2e13"),
        ("https___x_viewjob?jk=abc123&from=q.html", "abc123"),
        ("viewjob?jk=ABC.html", "viewjob?jk=ABC"),
        ("other.html", "other"),
        ("job_a.html.html", "a"),
        ("job_job_a.html", "a"),
    ],
)
def test_source_id(frame, name, expected):
    df = frame([(name,)], "n string").select(source_id(F.col("n")))
    assert df.first()[0] == expected


def test_split_errors(frame):
    rows = [("a.html", page("{}")), ("b.html", "")]
    parsed = parse_postings(frame(rows, "file_name string, html string"))
    good, bad = split_errors(parsed)
    assert [r.file_name for r in good.collect()] == ["a.html"]
    assert [(r.file_name, r.error_reason) for r in bad.collect()] == [("b.html", "no_json_ld")]


POSTING = """<h1> Data <i>Eng</i> </h1><h1>second</h1>
<a data-company-name="true"> A &amp; B </a><a data-company-name="false">no</a>
<div data-testid="inlineHeader-companyLocation"> Cor<b>doba </b></div>
<div id="jobDescriptionText"> <div>a <b> b</b></div>c<script>no</script><!-- no -->
<div>d</div></div><div>after</div>"""


def test_selectors(frame):
    rows = [("job_7.html", POSTING), ("8.html", "<p>none"), ("9.html", None)]
    df = parse_selectors(frame(rows, "file_name string, html string"))
    first, second, third = sorted(df.collect(), key=lambda r: r.job_url)
    assert first.job_title == "DataEng"
    assert first.company_name == "A & B"
    assert first.location == "Cordoba"
    assert first.job_description == "abcd"
    assert first.job_url == "https://indeed.com/viewjob?jk=7"
    assert first.posted_date is None and first.job_type is None
    assert second.job_title is None and second.job_description is None
    assert third.error_reason == "bad_encoding"


def test_selectors_ignore_hidden_headings(frame):
    html = "<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script><h1>yes</h1>"
    df = parse_selectors(frame([("a.html", html)], "file_name string, html string"))
    assert df.first().job_title == "yes"


def test_listing(frame):
    html = """<ul><li data-jk="1" href="u1"><div><span id="x-jobTitle-1"> T <b>1</b></span>
    </div><span id="jobTitle-2">later</span></li>
    <a data-jk="2"><span>none</span></a><p>no card</p></ul>"""
    pages = frame([("l.html", html), ("m.html", "<p>")], "file_name string, html string")
    rows = parse_listing(pages, F.lit("2024-01-31")).orderBy("card_no").collect()
    assert [(r.job_id, r.job_title, r.job_url) for r in rows] == [
        ("1", " T 1", "u1"),
        ("2", "Unknown", None),
    ]
    assert {(r.company_name, r.location, r.job_description) for r in rows} == {
        ("TBD", "Argentina", "TBD")
    }
    assert str(rows[0].scraped_date) == "2024-01-31"
