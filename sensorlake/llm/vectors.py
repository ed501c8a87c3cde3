"""Embedding near-duplicates by a subspace pigeonhole join.

Two unit vectors with cosine >= t lie within squared distance 2 - 2t. Vectors are turned by one
fixed random rotation and cut into blocks of ``BLOCK_DIMS`` coordinates; if the squared distances
of m blocks add up to that budget at most, some block's is an m-th of it at most. So each block is
a range join of points with 8 coordinates under radius r = sqrt((2 - 2t) / m): points go to the
cells of a grid (side ``CELL`` r) that lie within r / 2 of them, about five a block. The midpoint
of two points within r is within r / 2 of both, so its cell holds both.

Two passes over the cells. The first has the 8 coordinates only and keeps, of every cell, the
vectors with another within r. The second joins these to their components and compares them again:
a pair counts only in the first block within budget and there only in the midpoint's cell, so it
counts once, without a list of pairs; it is verified there, by cosine in double precision on the
components, and a task reports links per vector (summed) and a spanning forest of what it linked.
Only equal labels share a cell.

Vectors with equal components and label are one class with a number of members. A cell with
more classes than ``HOT`` and than a ten-thousandth of all is split: its members are dealt into
chunks, each compared with the whole cell in steps, so its work spreads over tasks.

Defined cases: null label, null, zero or empty vector, null or non-finite components: no link,
component is the row itself (kept); vectors of different lengths never link; null vec_id: links
count, but it names no component; repeated rows: members of one class, linked with each other;
empty input: empty result. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import n_parts, pinned, table
from sensorlake.llm.graph import components, spanning
from sensorlake.llm.simhash import pairs_by_group, whole_groups

COSINE = 0.98
BLOCK_DIMS = 8
CELL = 4.0              # side of a grid cell in radii; smaller cells: more rows, fewer comparisons
HOT = 2048              # classes of a cell that one task compares with each other
_SLACK = 1e-5           # for coordinates rounded to 32 bits
_STEP = 4096            # vectors placed at once


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every run."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _radius(dims: int, cosine: float) -> tuple[int, float]:
    blocks = max(1, -(-dims // BLOCK_DIMS))
    return blocks, float(np.sqrt(max(2 - 2 * cosine, 0) / blocks)) + _SLACK


def _turned(whole: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated, as 32-bit coordinates padded to whole blocks; a row's are the same in any batch."""
    scaled = whole / np.abs(whole).max(1, keepdims=True)
    unit = scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))
    dims = whole.shape[1]
    out, turn = np.zeros((len(whole), dims + -dims % BLOCK_DIMS)), rotation(dims)
    for d in range(dims):       # term by term: a product of matrices rounds by its shape
        out[:, :dims] += unit[:, d:d + 1] * turn[d]
    return out.astype(np.float32)


def _cells(points: np.ndarray, r: float, home: bool) -> tuple[np.ndarray, np.ndarray]:
    """(point, cell coordinates) of every grid cell within r / 2 of each point."""
    side = CELL * r
    at = np.floor(points / side).astype(np.int64)
    index, cells, spare = np.arange(len(points)), at, np.full(len(points), (r / 2 + _SLACK) ** 2)
    if home:
        return index, cells
    low, high = points - at * side, (at + 1) * side - points
    for d in range(points.shape[1]):
        parts = [(index, cells, spare)]
        for gap, step in ((low, -1), (high, 1)):
            left = spare - gap[index, d] ** 2
            near = left >= 0
            moved = cells[near].copy()
            moved[:, d] += step
            parts.append((index[near], moved, left[near]))
        index, cells, spare = map(np.concatenate, zip(*parts))
    return index, cells


def _cell_hash(label: np.ndarray, dims: np.ndarray | int, block: np.ndarray | int, cells: np.ndarray) -> np.ndarray:
    out = label.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(dims * 4096 + block).astype(np.uint64)
    for d in range(cells.shape[1]):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + cells[:, d].astype(np.uint64)
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (out ^ (out >> np.uint64(31))).view(np.int64)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    lengths = np.diff(batch.column("embedding").offsets.to_numpy())
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        for some in np.array_split(rows, len(rows) // _STEP + 1):
            if len(some):
                part = batch.take(pa.array(some))
                yield int(dims), part.column("embedding").flatten().to_numpy().astype(np.float64).reshape(-1, dims), part


def _fixed(column: np.ndarray, kind) -> np.ndarray:
    """A column of equally long byte strings as a matrix."""
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


CELLS = "cell long, piece int, node long, block int, left boolean, reach double, point binary"


def _place(cosine: float, pieces: dict[int, int], home: bool):
    """node, label, embedding -> a row for every cell of every block (with ``home``, its own cell only)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = np.array(sorted(pieces), np.int64)
        into = np.array([pieces[k] for k in sorted(pieces)], np.int32)
        for batch in batches:
            for dims, whole, part in _by_length(batch):
                turned = _turned(whole)
                blocks, r = _radius(dims, cosine)
                node, label = (part.column(c).to_numpy() for c in ("node", "label"))
                for b in range(blocks):
                    points = turned[:, b * BLOCK_DIMS:(b + 1) * BLOCK_DIMS]
                    index, cells = _cells(points.astype(np.float64), r, home)
                    cell = _cell_hash(label[index], dims, b, cells)
                    if home:
                        yield pa.RecordBatch.from_arrays([pa.array(cell)], ["cell"])
                        continue
                    piece, left = np.zeros(len(cell), np.int32), np.ones(len(cell), bool)
                    if len(split):
                        at = np.minimum(np.searchsorted(split, cell), len(split) - 1)
                        copies = np.where(split[at] == cell, into[at], 1)
                        again = np.repeat(np.arange(len(cell)), copies)
                        piece = (np.arange(len(again)) - np.repeat(np.cumsum(copies) - copies, copies)).astype(np.int32)
                        index, cell, copies = index[again], cell[again], copies[again]
                        left = (node[index] * 2654435761 >> 7) % copies == piece
                    point = pa.array([x.tobytes() for x in points], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), pa.array(piece), pa.array(node[index]), pa.array(np.full(len(cell), b, np.int32)),
                         pa.array(left), pa.array(np.full(len(cell), r * r)), point.take(pa.array(index))],
                        ["cell", "piece", "node", "block", "left", "reach", "point"])
    return run


def _several(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Without the groups of one row."""
    several = np.bincount(rows["group"])[rows["group"]] > 1
    rows = {k: v[several] for k, v in rows.items()}
    return rows | {"group": np.unique(rows["group"], return_inverse=True)[1]}


def _nearby():
    """Cells -> the rows that have another within the radius, without coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in map(_several, whole_groups(batches, ["cell", "piece"])):
            if not len(rows["group"]):
                continue
            points, found = _fixed(rows["point"], np.float32).astype(np.float64), np.zeros(len(rows["group"]), bool)
            for i, j in pairs_by_group(rows["group"], np.flatnonzero(rows["left"]), 1 << 19):
                near = (((points[i] - points[j]) ** 2).sum(1) <= rows["reach"][i]) & (rows["node"][i] != rows["node"][j])
                found[i[near]] = found[j[near]] = True
            at = np.flatnonzero(found)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(rows[k][at]) for k in _KEPT], _KEPT)
    return run


_KEPT = ["cell", "piece", "node", "block", "left"]


def _compare(cosine: float):
    """Cells with embeddings -> (node, -1, links), and the links of a spanning forest (node, other, 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in map(_several, whole_groups(batches, ["cell", "piece", "dims"])):
            for dims in np.unique(rows["dims"]):
                yield from _linked({k: v[rows["dims"] == dims] for k, v in rows.items()}, int(dims), cosine)
    return run


def _linked(rows: dict[str, np.ndarray], dims: int, cosine: float) -> Iterator[pa.RecordBatch]:
    group = np.unique(rows["group"], return_inverse=True)[1]
    whole = _fixed(rows["embedding"], np.float64)
    scaled, turned = whole / np.abs(whole).max(1, keepdims=True), _turned(whole).astype(np.float64)
    norm = np.sqrt((scaled * scaled).sum(1))
    blocks, r = _radius(dims, cosine)
    node, block = rows["node"], rows["block"]
    counts: dict[int, int] = {}
    kept = []
    for i, j in pairs_by_group(group, np.flatnonzero(rows["left"]), 1 << 15):
        use = node[i] < node[j]     # so once, also where a cell is split
        i, j = i[use], j[use]
        gaps = ((turned[i] - turned[j]) ** 2).reshape(len(i), blocks, BLOCK_DIMS).sum(2) <= r * r
        mine = gaps.any(1) & (gaps.argmax(1) == block[i])
        i, j = i[mine], j[mine]
        columns = block[i][:, None] * BLOCK_DIMS + np.arange(BLOCK_DIMS)
        middle = np.floor((turned[i[:, None], columns] + turned[j[:, None], columns]) / 2 / (CELL * r)).astype(np.int64)
        here = _cell_hash(rows["label"][i], dims, block[i], middle) == rows["cell"][i]
        i, j = i[here], j[here]
        ok = (scaled[i] * scaled[j]).sum(1) / (norm[i] * norm[j]) >= cosine
        i, j = i[ok], j[ok]
        if len(i):
            kept.append(spanning(node[i], node[j]))
            ends, at = np.unique(np.concatenate([node[i], node[j]]), return_inverse=True)
            for e, f in zip(ends.tolist(), np.bincount(at, np.concatenate([rows["n"][j], rows["n"][i]])).tolist()):
                counts[e] = counts.get(e, 0) + int(f)
    if counts:
        u, v = spanning(*map(np.concatenate, zip(*kept)))
        a, b = np.fromiter(counts, np.int64), np.fromiter(counts.values(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, u])), pa.array(np.concatenate([np.full(len(a), -1), v])),
             pa.array(np.concatenate([b, np.zeros(len(u), np.int64)]))], ["node", "other", "links"])


_USABLE = ("coalesce(label is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) "
           "and abs(x) < double('inf')) and exists(embedding, x -> x != 0), false)")


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.asarray(x.values, np.float64).tobytes() for x in batch.column("embedding")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "label", "n", "dims")),
                                          pa.array(raw, pa.binary())], ["node", "label", "n", "dims", "embedding"])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    n = n_parts(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(_USABLE).alias("usable"), F.when(
        F.expr(_USABLE), F.struct(F.col("label").cast("long").alias("label"),
                                  F.col("embedding").cast("array<double>").alias("embedding"))).alias("class"))
    classes = pinned(rows.filter("usable").groupBy("class").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
                     .select(F.monotonically_increasing_id().alias("node"), "class", "n", "first"))
    nodes = classes.select("node", "n", "class.label", "class.embedding")
    homes = nodes.mapInArrow(_place(cosine, {}, True), "cell long").groupBy("cell").agg(F.count("*").alias("n"))
    total = homes.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT, total // 10_000)
    split = {r.cell: -(-r.n // limit) for r in homes.filter(F.col("n") > limit).collect()}      # 10,000 at most
    placed = nodes.mapInArrow(_place(cosine, split, False), CELLS)
    near = (placed.repartition(n, "cell", "piece").sortWithinPartitions("cell", "piece")
            .mapInArrow(_nearby(), "cell long, piece int, node long, block int, left boolean"))
    whole = nodes.withColumn("dims", F.size("embedding")).mapInArrow(
        _as_bytes, "node long, label long, n long, dims int, embedding binary")
    found = pinned(near.join(whole, "node").repartition(n, "cell", "piece").sortWithinPartitions("cell", "piece", "dims")
                   .mapInArrow(_compare(cosine), "node long, other long, links long"))
    links = found.filter("other < 0").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("other >= 0").select(F.col("node").alias("u"), F.col("other").alias("v")))
    rooted = (classes.join(roots, "node", "left").join(links, "node", "left")
              .select("class", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                      F.coalesce("root", "node").alias("root")))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = rooted.join(named, "root").select("class", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return (rows.filter("usable").join(linked, "class").select("vec_id", "n_links", "component_id").union(alone)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op7_vectors(spark, sf_dir):
    """Links and component of every vector of ``embeddings``."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP7_SQL = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          AND list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach(node, seen) AS (SELECT vec_id, vec_id FROM embeddings
                      UNION SELECT node, b FROM reach JOIN links ON seen = a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, min(seen) AS component_id,
       vec_id = min(seen) AS kept
FROM embeddings JOIN reach ON node = vec_id GROUP BY vec_id
"""
