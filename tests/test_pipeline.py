import json

import pytest
from pyspark.sql import functions as F

from skillgauge import schemas
from skillgauge.plans import pipeline
from skillgauge.sources.files import read_pages, stream_pages
from skillgauge.sources.seed import catalog_frame, seed_catalog
from skillgauge.sources.tables import read_table
from skillgauge.streaming.ingest import ingest_stream


def save(folder, name, **fields):
    block = json.dumps(fields)
    text = f'<html><script type="application/ld+json">{block}</script></html>'
    (folder / f"{name}.html").write_text(text, encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    save(pages, "job_1", title="A", description="Python, Spark SQL", datePosted="2024-01-01")
    save(pages, "job_2", title="B", description="nothing known")
    save(pages, "v?jk=1", title="copy of 1", description="Java")
    save(pages, "job_3", title="C" * 300, description="SQL")
    save(pages, "job_4", title="D", description="SQL", datePosted="soon")
    save(pages, "job_5", title="E", description="AWS Glue and AWS")
    save(pages, "job_6", title="F", description="SQL", jobLocation=[])
    return pages


def now(day):
    return F.lit(f"2024-02-{day:02d} 00:00:00")


def row(df):
    return tuple(df.first())


def load_all(spark, folder, root, stamp, day):
    parsed = row(pipeline.parse_folder(spark, str(folder), root, stamp))
    return parsed, row(pipeline.load_jobs(spark, root, stamp, now(day)))


def test_from_pages_to_pairs(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    assert load_all(spark, folder, root, "1", 1) == ((7, 5, 1, 1), (3, 2, 5))
    rejected = read_table(spark, root, "rejected_jobs", "job_source_id string, error_reason string")
    assert sorted((r.job_source_id, r.error_reason) for r in rejected.collect()) == [
        ("3", "too_long:job_title"), ("4", "bad_date:posted_date")
    ]
    pipeline.load_catalog(seed_catalog(spark), root, "1", now(1))
    pipeline.extract_pairs(spark, root, "1")
    assert row(pipeline.load_pairs(spark, root, "1", now(2))) == (4, 0, 0, 4)
    pairs = read_table(spark, root, "job_skills", schemas.JOB_SKILLS).collect()
    assert sorted((r.job_title, r.skill_name) for r in pairs) == [
        ("A", "Python"), ("A", "Spark SQL"), ("E", "AWS"), ("E", "AWS Glue")
    ]
    jobs = {r.job_title: r for r in pipeline.current_jobs(spark, root).collect()}
    assert str(jobs["A"].skill_extraction_date) == "2024-02-02 00:00:00"
    assert jobs["B"].skill_extraction_date is None
    assert str(jobs["A"].posted_date) == "2024-01-01"


def test_repeats_change_nothing(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    load_all(spark, folder, root, "1", 1)
    before = pipeline.current_jobs(spark, root).collect()
    # The same load again, as after a lost driver, and a later load of the same.
    assert load_all(spark, folder, root, "1", 1)[1] == (3, 2, 5)
    assert load_all(spark, folder, root, "2", 5)[1] == (0, 2, 5)
    assert sorted(pipeline.current_jobs(spark, root).collect()) == sorted(before)

    pipeline.load_catalog(seed_catalog(spark), root, "1", now(1))
    pipeline.extract_pairs(spark, root, "1")
    assert row(pipeline.load_pairs(spark, root, "1", now(2))) == (4, 0, 0, 4)
    assert row(pipeline.load_pairs(spark, root, "1", now(2))) == (4, 0, 0, 4)
    assert row(pipeline.load_pairs(spark, root, "2", now(3), export="1")) == (0, 4, 0, 4)
    assert read_table(spark, root, "job_skills", schemas.JOB_SKILLS).count() == 4


@pytest.mark.parametrize("mark, waiting", [("inserted", ["B"]), ("scanned", [])])
def test_marks(spark, folder, tmp_path, mark, waiting):
    root = str(tmp_path / "root")
    load_all(spark, folder, root, "1", 1)
    pipeline.load_catalog(seed_catalog(spark), root, "1", now(1))
    pipeline.extract_pairs(spark, root, "1")
    # A job that arrives between the steps was not scanned and stays open.
    save(folder, "job_7", title="Late", description="Scala")
    load_all(spark, folder, root, "1b", 1)
    waiting = sorted([*waiting, "Late"])
    pipeline.load_pairs(spark, root, "1", now(2), mark=mark)

    def titles():
        return sorted(r.job_title for r in pipeline.open_jobs(spark, root).collect())

    assert titles() == waiting
    # A load that is run again after its marks were written marks the same jobs.
    pipeline.load_pairs(spark, root, "1", now(2), mark=mark)
    assert titles() == waiting
    save(folder, "job_9", title="New", description="Scala")
    load_all(spark, folder, root, "2", 3)
    assert titles() == sorted([*waiting, "New"])


def test_unknown_skills_fail_and_catalog_versions_add_up(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    load_all(spark, folder, root, "1", 1)
    pipeline.load_catalog(seed_catalog(spark), root, "1", now(1))
    pipeline.extract_pairs(spark, root, "1")
    # Only two skills are left when the pairs are loaded.
    other = str(tmp_path / "other")
    load_all(spark, folder, other, "1", 1)
    few = catalog_frame(spark, [("AWS", "cloud", []), ("Rust", "language", [])])
    pipeline.load_catalog(few, other, "1", now(1))
    pairs = spark.read.schema(schemas.PAIRS_EXPORT).json(f"{root}/exports/pairs/export_ts=1")
    from skillgauge.sources.files import write_export

    write_export(pairs, f"{other}/exports/pairs", "1")
    assert row(pipeline.load_pairs(spark, other, "1", now(2))) == (1, 0, 3, 4)
    pipeline.load_catalog(seed_catalog(spark), other, "2", now(2))
    names = [r.skill_name for r in pipeline.current_catalog(spark, other).collect()]
    assert len(names) == len(set(names)) == 96


def jobs_of(spark, root):
    jobs = read_table(spark, root, "jobs", schemas.JOBS).drop("load_id", "created_at")
    return sorted(jobs.collect(), key=repr)


def test_stream_equals_batch_and_counts_each_file_once(spark, folder, tmp_path):
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    checkpoint, archive = str(tmp_path / "cp"), str(tmp_path / "archive")

    def run():
        pages = stream_pages(spark, str(folder), archive)
        ingest_stream(pages, stream, checkpoint, now=now(1)).awaitTermination()

    load_all(spark, folder, batch, "1", 1)
    run()
    assert jobs_of(spark, stream) == jobs_of(spark, batch)
    run()
    assert jobs_of(spark, stream) == jobs_of(spark, batch)
    # A new posting, a copy of a stored one, and a page that cannot be read.
    save(folder, "job_8", title="H", description="Go")
    save(folder, "x?jk=2", title="copy of 2", description="Go")
    (folder / "bad.html").write_bytes(b"\xff")
    run()
    assert [r.job_title for r in jobs_of(spark, stream)].count("H") == 1
    assert len(jobs_of(spark, stream)) == len(jobs_of(spark, batch)) + 1


def test_a_batch_that_is_run_again_leaves_the_same_tables(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    pages = read_pages(spark, str(folder))
    for _ in range(2):
        pipeline.parse_pages(pages, root, "s-0")
        export = spark.read.schema(schemas.JOBS_EXPORT).json(
            f"{root}/exports/jobs/export_ts=s-0"
        )
        pipeline.merge_jobs(export, root, "s-0", now(1))
    assert len(jobs_of(spark, root)) == 3


def test_legacy_records_are_kept_once_per_address(spark, frame, tmp_path):
    from skillgauge.operators.dom import parse_listing, parse_selectors

    root = str(tmp_path / "root")
    page = '<h1>T</h1><div id="jobDescriptionText">SQL</div>'
    pages = frame(
        [("job_1.html", page), ("job_2.html", "<h1>no text</h1>"), ("job_3.html", page)],
        "file_name string, html string",
    )
    assert row(pipeline.merge_legacy_jobs(parse_selectors(pages), root, "1", now(1))) == (2, 1, 3)
    assert row(pipeline.merge_legacy_jobs(parse_selectors(pages), root, "2", now(2))) == (0, 1, 3)
    cards = """<a data-jk="1" href="https://indeed.com/viewjob?jk=1">x</a>
    <a data-jk="9" href="/nine"><span id="jobTitle-9">Nine</span></a>
    <a data-jk="8">no address</a><a data-jk="7">no address</a>"""
    listing = frame([("l.html", cards)], "file_name string, html string")
    records = parse_listing(listing, F.lit("2024-02-03"))
    assert row(pipeline.merge_legacy_jobs(records, root, "3", now(3))) == (3, 0, 4)
    stored = read_table(spark, root, "legacy_jobs", schemas.LEGACY_JOBS).collect()
    assert sorted((r.job_title, str(r.scraped_date)) for r in stored) == [
        ("Nine", "2024-02-03"), ("T", "2024-02-01"), ("T", "2024-02-01"),
        ("Unknown", "2024-02-03"), ("Unknown", "2024-02-03"),
    ]
    assert len({r.job_id for r in stored}) == 5


def test_texts_of_finished_and_new_loads_meet_no_join(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    load_all(spark, folder, root, "1", 1)
    pipeline.load_catalog(seed_catalog(spark), root, "1", now(1))
    pipeline.extract_pairs(spark, root, "1")
    pipeline.load_pairs(spark, root, "1", now(2), mark="scanned")
    save(folder, "job_9", title="New", description="Scala")
    load_all(spark, folder, root, "2", 3)
    waiting = pipeline.open_jobs(spark, root)
    assert [r.job_title for r in waiting.collect()] == ["New"]
    assert "Join" not in waiting._jdf.queryExecution().executedPlan().toString()


def test_workers_need_no_copy_of_the_package(tmp_path):
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from skillgauge.session import local_session\n"
        "from skillgauge.functions.text import with_html_text\n"
        "from skillgauge.operators.dom import parse_selectors\n"
        "spark = local_session('1')\n"
        "df = spark.createDataFrame([('a', '<h1>&eacute;</h1>')], 'file_name string, html string')\n"
        "print(with_html_text(df, 'html', 't').first().t, parse_selectors(df).first().job_title)\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=300,
    )
    assert done.stdout.split() == ["é", "é"], done.stderr[-2000:]


def test_a_backlog_in_small_batches(spark, folder, tmp_path):
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "cp")
    pages = stream_pages(spark, str(folder), max_files=2)
    ingest_stream(pages, root, checkpoint, now=now(1)).awaitTermination()
    jobs = read_table(spark, root, "jobs", schemas.JOBS)
    assert jobs.select("load_id").distinct().count() > 1
    assert sorted(r.job_source_id for r in jobs.collect()) == ["1", "2", "5"]


def test_a_new_checkpoint_keeps_earlier_loads(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    for checkpoint in ("cp1", "cp2"):
        pages = stream_pages(spark, str(folder))
        ingest_stream(pages, root, str(tmp_path / checkpoint), now=now(1)).awaitTermination()
        for name in ("job_1", "job_2"):
            (folder / f"{name}.html").unlink(missing_ok=True)
    assert sorted(r.job_source_id for r in jobs_of(spark, root)) == ["1", "2", "5"]


def test_a_stream_does_not_hide_the_newest_batch_export(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    pages = stream_pages(spark, str(folder))
    ingest_stream(pages, root, str(tmp_path / "cp"), now=now(1)).awaitTermination()
    save(folder, "job_9", title="Nine", description="x")
    assert load_all(spark, folder, root, "20240101", 2)[1] == (1, 2, 6)


def test_numeric_stamps_follow_by_value(spark, tmp_path):
    from pyspark.sql import functions as F

    from skillgauge import schemas
    from skillgauge.plans import pipeline
    from skillgauge.sources.seed import seed_catalog
    from skillgauge.sources.tables import read_table

    now = F.current_timestamp()
    for stamp, category in (("9", "old"), ("10", "new")):
        batch = seed_catalog(spark).withColumn("category", F.lit(category))
        pipeline.load_catalog(batch, str(tmp_path), stamp, now)
    assert {r.category for r in pipeline.current_catalog(spark, str(tmp_path)).collect()} == {"new"}
    assert read_table(spark, str(tmp_path), "skills", schemas.SKILLS).select("load_id").distinct().count() == 2


def test_a_mistyped_stamp_loads_nothing(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    load_all(spark, folder, root, "9", 1)
    for step in (pipeline.load_jobs, pipeline.load_pairs):
        with pytest.raises(FileNotFoundError):
            step(spark, root, "11", now(1))
    assert read_table(spark, root, "jobs", schemas.JOBS).select("load_id").distinct().count() == 1


def test_catalog_rules(spark, frame, tmp_path):
    rows = [("A", "c"), (None, "c"), ("B" * 101, "c"), ("C", "d" * 51), ("D  " + " " * 200, None)]
    batch = frame(rows, "skill_name string, category string")
    assert row(pipeline.load_catalog(batch, str(tmp_path), "1", now(1))) == (2, 3, 5)
    names = [r.skill_name for r in pipeline.current_catalog(spark, str(tmp_path)).collect()]
    assert sorted(n.rstrip() for n in names) == ["A", "D"] and all(len(n) <= 100 for n in names)
    bad = read_table(spark, str(tmp_path), "rejected_skills", "error_reason string").collect()
    assert sorted(r.error_reason for r in bad) == ["missing:skill_name", "too_long:category", "too_long:skill_name"]


def test_a_catalog_load_that_is_run_again_starts_from_the_same_version(spark, frame, tmp_path):
    root = str(tmp_path)

    def load(stamp, name):
        pipeline.load_catalog(frame([(name, "c")], "skill_name string, category string"), root, stamp, now(1))
        return sorted(r.skill_name for r in pipeline.current_catalog(spark, root).collect())

    assert load("9", "A") == ["A"] and load("10", "B") == ["A", "B"]
    # The newest version stays the one of load 10, and 9 does not take in its rows.
    assert load("9", "Z") == ["A", "B"]
    first = read_table(spark, root, "skills", schemas.SKILLS, only=["9"])
    assert [r.skill_name for r in first.collect()] == ["Z"]


def test_rows_with_null_keys_have_ids_of_their_own(spark, frame, tmp_path):
    root = str(tmp_path)
    export = frame(
        [(None, "1", "x", "T", "c", "u", "Python", None)] * 3 + [("s", None, "x", "T", "c", "u", "SQL", None), ("s", "1", "x", "T", "c", "u", "Go", None)],
        schemas.JOBS_EXPORT,
    )
    for stamp in ("1", "2", "2"):
        assert row(pipeline.merge_jobs(export, root, stamp, now(1)))[1:] == (0, 5)
    jobs = read_table(spark, root, "jobs", schemas.JOBS)
    ids = sorted((r.load_id, r.job_id) for r in jobs.collect())
    assert len(ids) == 9 and len({i for _, i in ids}) == 9
    pipeline.merge_jobs(export.repartition(7), root, "2", now(1))
    again = sorted((r.load_id, r.job_id) for r in read_table(spark, root, "jobs", schemas.JOBS).collect())
    assert again == ids
    pipeline.load_catalog(seed_catalog(spark), root, "1", now(1))
    pipeline.extract_pairs(spark, root, "1")
    assert row(pipeline.load_pairs(spark, root, "1", now(2))) == (8, 0, 0, 8)
    assert row(pipeline.load_pairs(spark, root, "2", now(2), export="1")) == (0, 8, 0, 8)


def consumed(spark, root):
    jobs = read_table(spark, root, "jobs", schemas.JOBS)
    return sorted((r.load_id, r.job_source_id) for r in jobs.collect())


def test_each_saved_page_is_consumed_once(spark, folder, tmp_path):
    import os

    root, pages = str(tmp_path / "root"), str(folder)
    (folder / "bad.html").write_bytes(b"\xff")
    (folder / "notes.txt").write_text("no page")
    (folder / "more").mkdir()
    save(folder / "more", "job_8", title="H", description="Go")
    assert row(pipeline.consume_pages(spark, pages, root, "9", now(1))) == (9, 9)
    assert sorted(os.listdir(folder)) == ["more", "notes.txt"] and not os.listdir(folder / "more")
    assert consumed(spark, root) == [("9", "1"), ("9", "2"), ("9", "5"), ("9", "8")]
    assert os.path.exists(f"{pages}_processed/9/more/job_8.html")
    # Nothing new; then one new page, and one under a name that was used before.
    assert row(pipeline.consume_pages(spark, pages, root, "10", now(2))) == (0, 0)
    save(folder, "job_9", title="N", description="Go")
    save(folder, "job_1", title="again", description="Go")
    assert row(pipeline.consume_pages(spark, pages, root, "11", now(2))) == (2, 2)
    assert consumed(spark, root)[0] == ("11", "9") and len(consumed(spark, root)) == 5


def test_a_run_that_was_broken_off_is_finished(spark, folder, tmp_path, monkeypatch):
    import os

    from skillgauge.sources import pages as source

    root, pages = str(tmp_path / "root"), str(folder)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "load_jobs", fail)
        with pytest.raises(RuntimeError):
            pipeline.consume_pages(spark, pages, root, "1", now(1))
    # Files that came since belong to the next run.
    save(folder, "job_9", title="N", description="Go")
    with monkeypatch.context() as patch:
        patch.setattr(source, "move_pages", fail)
        with pytest.raises(RuntimeError):
            pipeline.consume_pages(spark, pages, root, "1", now(1))
    assert len(os.listdir(folder)) == 8
    assert row(pipeline.consume_pages(spark, pages, root, "2", now(1))) == (1, 1)
    assert consumed(spark, root) == [("1", "1"), ("1", "2"), ("1", "5"), ("2", "9")]
    assert not os.listdir(folder)


def test_a_page_that_cannot_be_moved_is_not_taken_again(spark, folder, tmp_path):
    root, pages = str(tmp_path / "root"), str(folder)
    target = tmp_path / "pages_processed" / "1"
    target.mkdir(parents=True)
    (target / "job_1.html").write_text("in the way")
    assert row(pipeline.consume_pages(spark, pages, root, "1", now(1))) == (7, 6)
    assert row(pipeline.consume_pages(spark, pages, root, "2", now(1))) == (0, 0)
    save(folder, "job_1", title="changed", description="Go, Rust and more")
    assert row(pipeline.consume_pages(spark, pages, root, "3", now(1))) == (1, 1)
