import json
import os

import pytest

from skillgauge import schemas
from skillgauge.sources import files
from skillgauge.sources.commits import read_log
from skillgauge.sources.tables import append_load, compact_loads, read_loads, read_table, table_loads


@pytest.fixture
def folder(tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "job_1.html").write_text("<p>ü</p>\r\nx\ry", encoding="utf-8", newline="")
    (pages / "job_2.html").write_bytes(b"<p>\xff\xfe</p>")
    (pages / "notes.txt").write_text("no page")
    return pages


def test_read_pages(spark, folder):
    rows = {r.file_name: r for r in files.read_pages(spark, str(folder)).collect()}
    assert set(rows) == {"job_1.html", "job_2.html"}
    assert rows["job_1.html"].html == "<p>ü</p>\nx\ny"
    assert rows["job_2.html"].html is None
    assert rows["job_1.html"].file_path.endswith("/pages/job_1.html")


def test_compact_pages(spark, folder, tmp_path):
    path = str(tmp_path / "compact")
    files.compact_pages(files.read_pages(spark, str(folder)), path)
    assert spark.read.parquet(path).count() == 2


def test_exports_keep_all_keys_and_the_newest_is_read(spark, frame, tmp_path):
    root = str(tmp_path / "jobs")
    old = frame([("a", "b", "c")], schemas.PAIRS_EXPORT)
    new = frame([("ü\n", None, "d")], schemas.PAIRS_EXPORT)
    path = files.write_export(new, root, "20240102_000000")
    files.write_export(old, root, "20240101_235959")
    lines = [
        json.loads(line)
        for name in os.listdir(path)
        if name.endswith(".json")
        for line in open(f"{path}/{name}", encoding="utf-8")
    ]
    assert lines == [{"job_id": "ü\n", "job_title": None, "skill_name": "d"}]
    latest = files.latest_export(spark, root, schemas.PAIRS_EXPORT)
    assert [tuple(r) for r in latest.collect()] == [("ü\n", None, "d")]
    assert files.read_exports(spark, root, schemas.PAIRS_EXPORT).count() == 2


def test_an_export_is_replaced_by_a_repeat_and_may_be_empty(spark, frame, tmp_path):
    root = str(tmp_path / "jobs")
    rows = frame([("a", "b", "c")], schemas.PAIRS_EXPORT)
    for _ in range(2):
        files.write_export(rows, root, "1")
    assert files.latest_export(spark, root, schemas.PAIRS_EXPORT).count() == 1
    files.write_export(rows.limit(0), root, "2")
    assert files.latest_export(spark, root, schemas.PAIRS_EXPORT).count() == 0


def test_no_export(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.latest_export(spark, str(tmp_path / "none"), schemas.PAIRS_EXPORT)


def test_array_export(spark, tmp_path):
    rows = [{"job_id": "1", "job_title": None, "skill_name": "ü"}, {"job_id": "2"}]
    path = tmp_path / "skills_export_1.json"
    path.write_text(json.dumps(rows, indent=2, ensure_ascii=False), encoding="utf-8")
    got = files.read_array_export(spark, str(path), schemas.PAIRS_EXPORT).collect()
    assert [tuple(r) for r in got] == [("1", None, "ü"), ("2", None, None)]


def test_csv_keeps_texts_apart(spark, frame, tmp_path):
    values = ["plain", 'say "x", y', "two\nlines", "", None, " padded ", "back\\slash", "\\N", 'e\\"']
    df = frame([(i, v) for i, v in enumerate(values)], "i int, v string")
    path = str(tmp_path / "csv")
    files.write_csv(df, path)
    got = files.read_csv(spark, path, "i int, v string").orderBy("i").collect()
    values[7] = None  # the null marker itself
    assert [r.v for r in got] == values


def test_tables(spark, frame, tmp_path):
    root = str(tmp_path)
    assert read_table(spark, root, "t", "a int").count() == 0
    append_load(frame([(1,)], "a int"), root, "t", "l1")
    for value in (2, 3):
        append_load(frame([(value,)], "a int"), root, "t", "l2")
    append_load(frame([], "a int"), root, "t", "l3")
    rows = read_table(spark, root, "t", "a int").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "l1"), (3, "l2")]
    assert [r.a for r in read_table(spark, root, "t", "a int", but="l2").collect()] == [1]
    one = read_loads(spark, root, "t", "a int", ["l2"])
    assert [r.a for r in one.collect()] == [3]
    # Only the folder of the load is opened.
    assert len({os.path.dirname(f) for f in one.inputFiles()}) == 1


def test_move_files(spark, folder, tmp_path):
    target = f"file://{tmp_path}/done/20240101"
    pages = files.read_pages(spark, str(folder)).select("file_path")
    missing = spark.createDataFrame([("file:///nowhere/x.html",)], "file_path string")
    paths = spark.createDataFrame(pages.unionByName(missing).collect(), "file_path string")
    moves = files.move_files(paths, target)
    for _ in range(2):  # a repeat finds them moved
        assert tuple(files.move_summary(moves).first()) == (2, 1)
    assert sorted(os.listdir(tmp_path / "done/20240101")) == ["job_1.html", "job_2.html"]
    assert os.listdir(folder) == ["notes.txt"]


def test_a_load_without_commit_is_not_seen(spark, frame, tmp_path):
    root = str(tmp_path)
    append_load(frame([(1,)], "a int"), root, "t", "9")
    frame([(7, "x")], "a int, load_id string").write.parquet(f"{root}/t/broken")
    assert [r.a for r in read_table(spark, root, "t", "a int").collect()] == [1]


def test_loads_keep_their_place_when_repeated(spark, frame, tmp_path):
    root = str(tmp_path)
    for load, value in (("9", 1), ("10", 2), ("9", 3)):
        append_load(frame([(value,)], "a int"), root, "t", load)
    assert [(x.load_id, x.sequence, x.n_rows) for x in table_loads(spark, root, "t")] == [("9", 1, 1), ("10", 2, 1)]
    assert sorted(r.a for r in read_table(spark, root, "t", "a int").collect()) == [2, 3]
    assert len(read_log(spark, f"{root}/t_log")) == 3


def test_two_writers_of_one_commit_collide(spark, tmp_path):
    from skillgauge.sources.commits import Load, commit

    commit(spark, str(tmp_path / "log"), [Load(1, 1, "a", "f", 0, "f")])
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        commit(spark, str(tmp_path / "log"), [Load(1, 1, "b", "g", 0, "g")])


def test_compacted_loads(spark, frame, tmp_path):
    root = str(tmp_path)
    for no in range(5):
        append_load(frame([(no,), (no,)], "a int"), root, "t", str(no))
    append_load(frame([], "a int"), root, "t", "empty")

    def rows():
        return sorted(tuple(r) for r in read_table(spark, root, "t", "a int").collect())

    before = rows()
    assert compact_loads(spark, root, "t", "a int", keep=2) == 4
    assert rows() == before and len({x.folder for x in table_loads(spark, root, "t")}) == 3
    assert compact_loads(spark, root, "t", "a int", keep=2) == 0
    # A load in the compacted folder can be replaced, left out and picked.
    append_load(frame([(70,)], "a int"), root, "t", "1")
    assert rows() == sorted([r for r in before if r[1] != "1"] + [(70, "1")])
    assert {r.a for r in read_loads(spark, root, "t", "a int", ["0", "1"]).collect()} == {0, 70}
    assert compact_loads(spark, root, "t", "a int", keep=0) == 6
    assert len({x.folder for x in table_loads(spark, root, "t")}) == 1
    assert rows() == sorted([r for r in before if r[1] != "1"] + [(70, "1")])


def test_exports_by_number_and_unknown_ones(spark, frame, tmp_path):
    root = str(tmp_path / "jobs")
    for stamp in ("9", "10"):
        files.write_export(frame([(stamp, "b", "c")], schemas.PAIRS_EXPORT), root, stamp)
    assert files.latest_stamp(spark, root) == "10"
    with pytest.raises(FileNotFoundError):
        files.read_export(spark, root, schemas.PAIRS_EXPORT, "11")


def test_page_folders(spark, folder, tmp_path):
    from skillgauge.sources import pages

    rows = {r.file_name: r for r in pages.read_folder(spark, f"file://{folder}").collect()}
    assert set(rows) == {"job_1.html", "job_2.html"}
    assert rows["job_1.html"].html == "<p>ü</p>\nx\ny" and rows["job_2.html"].html is None
    assert rows["job_1.html"].size == os.path.getsize(folder / "job_1.html")
    os.mkdir(folder / "none")
    assert pages.read_folder(spark, str(folder / "none")).count() == 0
    out = str(tmp_path / "out")
    given = spark.createDataFrame([(f"p{i}?a&b.html", f"é {i}") for i in range(50)], "file_name string, html string")
    pages.write_folder(given.repartition(4), out)
    got = pages.read_folder(spark, out).select("file_name", "html")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, given.collect()))
    parts = spark.read.format("saved_pages").option("partBytes", 10 * 2**16).load(out)
    assert parts.rdd.getNumPartitions() == 5
    fanned = str(tmp_path / "fanned")
    pages.write_folder(given.repartition(4), fanned, fan=7)
    assert len(os.listdir(fanned)) == 7
    got = pages.read_folder(spark, fanned).select("file_name", "html")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, given.collect()))


def test_stored_keys_meet_a_batch_without_moving(spark, frame, tmp_path):
    from skillgauge.sources.keys import known_keys
    from skillgauge.sources.tables import append_keyed_load

    root, keys, schema = str(tmp_path), ["a", "b"], "a string, b string"

    def load(rows, name):
        append_keyed_load(frame(rows, schema), root, "t", name, keys)

    batch = frame([("x", "1"), ("x", "1"), ("x", "2"), (None, "1"), ("y", None), ("z", "9")], schema)
    assert known_keys(batch, root, "t", keys).count() == 0
    load([("x", "1"), (None, "1")], "1")
    load([("z", "9"), ("q", "q")], "2")
    known = known_keys(batch, root, "t", keys)
    assert sorted(map(tuple, known.collect())) == [("x", "1"), ("z", "9")]
    assert sorted(map(tuple, known_keys(batch, root, "t", keys, but="2").collect())) == [("x", "1")]
    # The stored side is read in its buckets: what is above its scan is no exchange.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        plan = known_keys(batch, root, "t", keys)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    at = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
    above, depth = [], plan[at].index("- ")
    for line in reversed(plan[:at]):
        if "- " in line and line.index("- ") < depth:
            depth = line.index("- ")
            above.append(line)
            if "Join" in line:
                break
    assert "Join" in above[-1] and not [line for line in above if "Exchange" in line]
    # A load that is replaced gives its keys up; moving rows does not.
    load([("x", "2")], "1")
    assert sorted(map(tuple, known_keys(batch, root, "t", keys).collect())) == [("x", "2"), ("z", "9")]
    compact_loads(spark, root, "t", schema, keep=0)
    assert sorted(map(tuple, known_keys(batch, root, "t", keys).collect())) == [("x", "2"), ("z", "9")]


def test_pages_are_written_from_arrow_batches_one_text_at_a_time(tmp_path):
    import pyarrow as pa

    from skillgauge.sources import pages

    texts = ["<p>größer 日本</p>", None, "", "x" * 5000]
    rows = pa.RecordBatch.from_pydict({"file_name": [f"p{i}.html" for i in range(4)], "html": pa.array(texts, pa.string())})
    written = pages._Writer(str(tmp_path), 0).write(iter([rows.slice(0, 1), rows.slice(1)]))
    assert written.n == 4
    assert [(tmp_path / f"p{i}.html").read_text(encoding="utf-8") for i in range(4)] == [t or "" for t in texts]
    assert len(list(tmp_path.iterdir())) == 4
