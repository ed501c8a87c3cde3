import itertools

import numpy as np
import zstandard
from pyspark.sql import functions as F

from sensorlake.llm import vectors, warc
from sensorlake.session import scratch_path
from tests.llm import brute
from tests.llm.conftest import SF, plain


def planted(dims=16, seed=1):
    draw = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        centres = draw.standard_normal((6, dims))
        for c in centres:
            for _ in range(8):      # cosines on both sides of the threshold
                rows.append((c / np.linalg.norm(c) + draw.standard_normal(dims) * draw.choice([0.01, 0.04, 0.06]) , label))
    return [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]


ODD = [(None, [1.0, 0.0], 0), (900, [2.0, 0.0], 0), (900, [2.0, 0.0], 0), (901, None, 0), (902, [], 0), (903, [0.0, 0.0], 0),
       (904, [float("nan"), 1.0], 0), (905, [float("inf"), 1.0], 0), (906, [None, 1.0], 0), (907, [1.0, 0.0], None),
       (908, [1.0, 0.0], 1), (909, [1.0, 0.0, 0.0], 0), (910, [1e200, 1e198], 0), (911, [-1.0, 0.0], 0), (912, [1e-200, 0.0], 0)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "vec_id long, embedding array<double>, label int, node int, cell string")


def test_vectors_against_all_pairs(spark, monkeypatch):
    rows = planted() + ODD
    exp = plain(map(list, brute.vectors(rows)))
    assert plain(map(list, vectors.near_duplicates(frame(spark, rows)).collect())) == exp
    monkeypatch.setattr(vectors, "HOT", 3)      # split cells
    assert plain(map(list, vectors.near_duplicates(frame(spark, rows)).collect())) == exp
    assert vectors.near_duplicates(frame(spark, [])).count() == 0


def test_every_pair_within_the_threshold_shares_a_cell():
    draw = np.random.default_rng(7)
    a = draw.standard_normal((300, 64))
    b = a / np.linalg.norm(a, axis=1, keepdims=True) + draw.standard_normal((300, 64)) * 0.024
    x, y = vectors._turned(a).astype(float), vectors._turned(b).astype(float)
    near = ((x - y) ** 2).sum(1) <= 0.04
    assert near.sum() > 50
    blocks, r = vectors._radius(64, 0.98)
    met = np.zeros(300, bool)
    for k in range(blocks):
        part = slice(k * 8, k * 8 + 8)
        homes = [set(zip(i.tolist(), map(tuple, c.tolist()))) for i, c in (vectors._cells(p[:, part], r, False) for p in (x, y))]
        met[[i for i, _ in homes[0] & homes[1]]] = True
    assert met[near].all()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")


PAGES = [(1, "http://a/1", "x" * 1500), (2, None, "x" * 1500), (3, "http://a/ 3\r\n", "x" * 1500), (4, "http://a/4", "short"),
         (5, "http://a/5", "short"), (6, "http://a/6", None), (None, "http://a/7", "x" * 1500), (8, "http://a/8", "é" * 500),
         (9, "http://a/9", "é" * 500), (10, "http://a/10", "é" * 499), (11, "http://a/11", "é" * 499),
         (12, "http://a/12", "line\r\n\r\nWARC/1.1\r\n" * 20000), (9, "http://a/9", "é" * 500)]


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)     # several archives a task
    rows = PAGES + [(100 + i, f"http://b/{i}", f"<html><body>page {i} of many, all alike</body></html>" * 4) for i in range(400)]
    manifest = warc.write(pages(spark, rows), str(tmp_path / "warc"))
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 1
    got = warc.read(manifest).collect()
    assert sorted((r.page_id or -1, r.payload_bytes) for r in got) == sorted((p or -1, len((h or "").encode())) for p, _, h in rows)
    for r in got:
        html = next((h or "").encode() for p, _, h in rows if p == r.page_id)
        assert r.payload == (None if r.record_type == "revisit" else html)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert [kinds[i] for i in (1, 2, 3, None)] == [("revisit", 3), ("revisit", 3), ("response", None), ("revisit", 3)]
    assert [kinds[i] for i in (4, 5, 6, 8, 9, 10, 11)] == [("response", None)] * 3 + [("revisit", 9)] + [("response", None)] * 3
    data = open(manifest.first().path, "rb").read()
    assert data[:4] == bytes.fromhex("5d2a4d18")        # the dictionary leads
    learned = zstandard.ZstdCompressionDict(data[8:8 + int.from_bytes(data[4:8], "little")])
    assert learned.dict_id() and sum(1 for _ in warc.frames(data)) >= 2


def test_small_and_empty_tables(spark, tmp_path):
    manifest = warc.write(pages(spark, PAGES[:4]), str(tmp_path / "few"))      # too few records for a dictionary
    assert warc.read(manifest).count() == 4
    assert warc.read(warc.write(pages(spark, []), str(tmp_path / "none"))).count() == 0


def test_archives_of_pages_leave_nothing_behind(spark):
    assert warc.op9_warc(spark, SF).count() == 50
