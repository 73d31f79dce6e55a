"""Exact top-k and archives: odd rows against plain versions."""

import hashlib
import math
import random

import pytest

pytest.importorskip("skillgauge.llm")

from skillgauge.llm import bitslice, queries, warc  # noqa: E402
from skillgauge.session import fresh_path  # noqa: E402

VECTORS = "vec_id long, embedding array<double>"


def plain_top(rows, k=5):
    good = [(i, [math.floor(x * 256) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(q, tuple(a)) for q, a in good if q % 50 == 0}:
        found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(a) == len(b))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run_top(spark, rows, tmp_path):
    path = str(tmp_path / "data")
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{path}/embeddings.parquet")
    return sorted(map(tuple, queries.op1_exact_top_k(spark, path).collect()))


def test_top_k_of_odd_vectors(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(1, 300)]
    rows += [(50, [70000.0] * 8), (100, [-70000.5] + [0.0] * 7), (301, [1e6] * 8), (302, [2.0**30] + [0.0] * 7)]
    rows += [(303, None), (304, [None] * 8), (305, [math.nan] * 8), (306, [math.inf] * 8), (307, []), (150, []), (308, [1.0] * 3)]
    rows += [(i, [0.5] * 8) for i in (400, 401, 401, 402, 450)]
    rows += [(None, [9.0] * 8)]
    assert run_top(spark, rows, tmp_path) == plain_top(rows)


def test_top_k_of_nothing(spark, tmp_path):
    assert run_top(spark, [], tmp_path) == []


def test_too_large_component_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="too large"):
        run_top(spark, [(1, [1e300]), (50, [1.0])], tmp_path)


def test_low_bits_are_resolved():
    import numpy as np

    rng = np.random.default_rng(3)
    values = rng.integers(-2**30, 2**30, (200, 4))
    weights = rng.integers(-2**30, 2**30, (3, 4))
    ids = np.arange(200)
    slices = bitslice.slice_block(values, 2)
    q, r, score = bitslice.search_block(ids, values, slices, 2, np.array([-1, -2, -3]), weights, 5)
    for at in range(3):
        want = sorted(((-(values[i].astype(object) @ weights[at].astype(object)), i) for i in ids))[:5]
        assert [(-s, i) for s, i in zip(score[q == at], r[q == at], strict=True)] == want


PAGES = "page_id long, url string, html string, extra string"


def test_archives_of_odd_pages(spark, tmp_path):
    big = "é" * 500_000
    rows = [(1, "http://a/", "x" * 200, "1"), (2, "http://b/", "x" * 200, "2"), (2, "http://b/", "x" * 200, "2"), (3, None, None, None), (4, "", "", ""),
            (5, "http://c/", "short", ""), (6, "http://d/", "short", ""), (8, "http://e/ x", big, ""), (7, "u", big, ""), (9, "u", "a\r\n\r\nWARC/1.1\r\n" * 20, "")]
    path = str(tmp_path / "data")
    spark.createDataFrame(rows, PAGES).write.parquet(f"{path}/pages.parquet")
    want = []
    for i, _, html, _ in rows:
        body = (html or "").encode()
        first = min(j for j, _, other, _ in rows if (other or "").encode() == body)
        again = len(body) >= 100 and i != first
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else -1))
    got = [(*r[:4], -1 if r.refers_to is None else r.refers_to) for r in queries.op10_warc(spark, path).collect()]
    assert sorted(got) == sorted(want)


def test_archives_of_nothing(spark, tmp_path):
    path = str(tmp_path / "data")
    spark.createDataFrame([], PAGES).write.parquet(f"{path}/pages.parquet")
    assert queries.op10_warc(spark, path).collect() == []


def test_damaged_archives_are_reported(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50, "") for i in range(20)], PAGES).coalesce(1)
    marked = warc.mark_revisits(pages, "page_id", "html", 100, fresh_path(spark, "firsts"))
    path = str(tmp_path / "warc")
    warc.write_archives(marked, path, warc.train_dictionary(pages, "html"), queries.WARC_DATE, ("page_id", "url", "refers_to", "html"))
    from pathlib import Path

    file = next(p for p in Path(path).rglob("*") if p.is_file() and p.suffix not in (".crc",) and p.stat().st_size > 1000 and not p.name.startswith((".", "_")))
    file.write_bytes(file.read_bytes()[:-20])
    crc = file.with_name(f".{file.name}.crc")
    if crc.exists():
        crc.unlink()
    rows = warc.read_archives(spark, path).collect()
    assert any(r.error for r in rows)
