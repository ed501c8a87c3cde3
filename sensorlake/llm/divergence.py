"""Source divergence audit: which terms set the sources of a language apart, and by how much.

Terms are runs of letters (ASCII letters, folded, and every character beyond ASCII). A language
keeps the terms that stand in at least ``MIN_DOCS`` of its documents; they are found by Iceberg
prefix refinement, so rare terms, the most of all, drop out early:

1. One pass over the texts. A task counts, over what it holds, in how many documents of a language
   each byte prefix of ``LEVELS`` lengths stands, and for complete terms by source also how often.
   A document is in one task, so the numbers of tasks add up. Prefixes are written as rows, a folder a
   level; complete terms stay packed in blocks (columns, compressed). No text is shuffled.
2. Level by level, what extends a kept prefix of the level before is summed up, and prefixes in
   too few documents are discarded with all that would extend them. The kept prefixes are broadcast
   while they are ``BROADCAST_ROWS`` rows at most, and joined by a shuffle beyond.
3. The complete terms under kept prefixes are the candidates. Blocks are filtered by a bit table of the
   last level's kept prefixes (2 ** ``FILTER_BITS`` bits, broadcast, whatever the corpus; a false hit is a
   candidate more), split by a hash of language and term, and added up, a part a task; the candidates
   in enough documents stay. That test is exact and decides alone.

A group is a (lang, source) that occurs. With count occurrences of a term in it, N over all kept
terms and V kept terms of the language, p = 1 + floor(10^9 (count + 1) / (N + V)); from q to p a
term adds f = floor((p - q)^2 / q). Everything is in whole numbers. For pairs of sources the sum over
all kept terms is split: terms that neither has are alike; terms that one has depend on its count
alone, so they are taken from a histogram; only terms that both have are met one by one, per term
in numpy, and a task puts out one number a pair of sources.

Defined cases: null text, lang and source are empty strings, and the empty language and source are
ones like others; documents without a term are in the group and in no count; every row is a document,
repeated rows and ids too; a language without kept terms has pairs of value 0; a language of one
source has no pair; ties go by the item's bytes; whole texts of any length; an empty table gives no
row. Only text, lang and source are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import n_parts, pinned, steps, table
from sensorlake.llm.kernels import SPREAD, Hasher, Texts, mixed, words
from sensorlake.llm.packed import slices
from sensorlake.session import delete_path, scratch_path

MIN_DOCS = 3
TOP_TERMS = 200
LEVELS = (2, 4, 8)          # bytes of the prefixes, before complete terms
BROADCAST_ROWS = 1 << 18    # kept prefixes (of 8 bytes and a language) that are broadcast
PER_MILLIARD = 1_000_000_000
FILTER_BITS = 26            # of the broadcast table of kept prefixes: 8 MB
_HELD_ROWS = 1 << 19        # counts that a task holds before it puts some out
_HASH_ROWS = 1 << 15        # rows that are hashed at once
_PAIRS = 1 << 20            # pairs of sources that a task compares at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

_COUNTED = "level int, lang string, item binary, docs long, block binary"
_SPLIT = "part int, block binary"


# ----------------------------------------------------------------------------- one pass over the texts

def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many rows each has."""
    key = np.sort(key)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.diff(np.r_[first, len(key)])


def _summed(key: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of their weights."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], *[np.add.reduceat(w[order], first) if len(key) else w for w in weights]


def _step_counts(batch: pa.RecordBatch, levels: tuple[int, ...], groups: dict) -> list[tuple]:
    """(group number, items, documents, occurrences) of a few texts, for complete terms and every prefix length."""
    texts = Texts(batch.column("text"))
    starts, ends, first = words(texts, _LETTER)
    if not len(starts):
        return []
    letters = _LOWER[texts.data[_LETTER[texts.data]]]       # the terms, end to end
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = terms.dictionary_encode()
    items, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
    pair, n = _counted(doc * len(items) + code)             # a term once a document
    doc, code = pair // len(items), pair % len(items)
    langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()

    def number(level: int) -> np.ndarray:
        return np.array([groups.setdefault((level, g, s if level == 0 else ""), len(groups)) for g, s in zip(langs, sources)])

    key, docs, occurs = _summed(number(0)[doc] * len(items) + code, np.ones(len(n), np.int64), n)
    out = [(key // len(items), items.take(pa.array(key % len(items))), docs, occurs)]
    for level in levels:
        cut = pc.binary_slice(items, 0, level).dictionary_encode()
        prefix = cut.indices.to_numpy().astype(np.int64)[code]
        width = len(cut.dictionary)
        once, _ = _counted(doc * width + prefix)            # a prefix once a document, however many terms extend it
        key, docs = _counted(number(level)[once // width] * width + once % width)
        out.append((key // width, cut.dictionary.take(pa.array(key % width)), docs, np.zeros(len(key), np.int64)))
    return out


def _merged(held: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(held).group_by(["g", "item"], use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
    return pa.table({"g": whole["g"], "item": whole["item"], "docs": whole["docs_sum"], "n": whole["n_sum"]})


def _pack(t: pa.Table, names: list[tuple[str, str]]) -> bytes:
    """A block: group number, item, docs, n, compressed; the groups' (lang, source) in the schema."""
    t = t.replace_schema_metadata({"groups": json.dumps(names)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(t)
    return sink.getvalue().to_pybytes()


def _unpack(block: bytes) -> tuple[pa.Table, list[tuple[str, str]]]:
    t = pa.ipc.open_stream(block).read_all()
    return t, [tuple(g) for g in json.loads(t.schema.metadata[b"groups"])]


def _give_back() -> None:
    """What Arrow has freed goes back to the system: a worker serves task after task, and all cores' workers count."""
    pa.default_memory_pool().release_unused()


def _counts(levels: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, int] = {}
        held, rows = [], 0

        def put(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t, names = t.combine_chunks(), list(groups)
            complete = np.array([k[0] == 0 for k in names])[t["g"].to_numpy()]
            if complete.any():
                block = _pack(t.filter(pa.array(complete)), [(k[1], k[2]) for k in names])
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([""]), pa.array([b""]), pa.array([0]),
                                                  pa.array([block], pa.binary())], ["level", "lang", "item", "docs", "block"])
            for b in t.filter(pa.array(~complete)).combine_chunks().to_batches(max_chunksize=1 << 16):
                g = b.column("g")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in names], pa.int32()).take(g), pa.array([k[1] for k in names]).take(g),
                     b.column("item").cast(pa.binary()), b.column("docs"), pa.nulls(b.num_rows, pa.binary())],
                    ["level", "lang", "item", "docs", "block"])

        for batch in steps(batches):
            for g, item, docs, n in _step_counts(batch, levels, groups):
                held.append(pa.table({"g": pa.array(g, pa.int64()), "item": item, "docs": pa.array(docs, pa.int64()),
                                      "n": pa.array(n, pa.int64())}))
                rows += len(g)
            if rows > _HELD_ROWS:
                held = [_merged(held)]
                rows = held[0].num_rows
                if rows > _HELD_ROWS // 2:
                    yield from put(held[0])
                    held, rows = [], 0
                _give_back()
        if held:
            yield from put(_merged(held))
        held = []
        _give_back()
    return run


# ----------------------------------------------------------------------------- prefix refinement

_HASH = Hasher(12)


def _hashes(items: pa.Array, group: np.ndarray, langs: list[str]) -> np.ndarray:
    """64-bit hashes of (language, item); ``group`` is the row's index into ``langs``. Some rows at a time: the hasher
    takes dozens of bytes for a byte of its input."""
    own = Texts(pa.array(langs, pa.large_string()))
    of_lang = _HASH.runs(_HASH.sums(own.data), own.off[:-1], own.off[1:])
    out = np.empty(len(items), np.uint64)
    for lo in range(0, len(items), _HASH_ROWS):
        texts = Texts(items.slice(lo, _HASH_ROWS))
        of_item = _HASH.runs(_HASH.sums(texts.data), texts.off[:-1], texts.off[1:])
        out[lo:lo + _HASH_ROWS] = mixed(of_item * SPREAD + of_lang[group[lo:lo + _HASH_ROWS]])
    return out


def _bit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            langs = batch.column("lang").dictionary_encode()
            at = _hashes(batch.column("item"), langs.indices.to_numpy(), langs.dictionary.to_pylist()) >> np.uint64(64 - FILTER_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], ["bit"])


def _bit_table(kept: DataFrame) -> np.ndarray:
    """The hashes' leading bits of all kept prefixes as a table of 2 ** FILTER_BITS bits, built by Spark's bitmap aggregate."""
    table_ = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    rows = (kept.mapInArrow(_bit_rows, "bit long").groupBy(F.call_function("div", F.col("bit"), F.lit(32768)).alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bit % 32768)").alias("bits")))
    for r in rows.toLocalIterator():        # 4 KB each, 2,048 of them at most
        table_[r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return table_


def _split(parts: int, length: int, shared):
    """Blocks -> for every part of the hash space, the candidates of each block as a block of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for block in batch.column("block").to_pylist():
                t, names = _unpack(block)
                items, g = t["item"].combine_chunks(), t["g"].to_numpy()
                langs = [n[0] for n in names]
                if bits is not None:
                    at = (_hashes(pc.binary_slice(items, 0, length), g, langs) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    t = t.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
                    items, g = t["item"].combine_chunks(), t["g"].to_numpy()
                part = (_hashes(items, g, langs) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                t, part = t.take(pa.array(order)), part[order]
                for number, lo, hi in slices(part):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), pa.array([_pack(t.slice(lo, hi - lo).combine_chunks(), names)], pa.binary())],
                        ["part", "block"])
    return run


def _kept_of_part(min_docs: int):
    """The blocks of some parts -> lang, source, term, n of the terms that are in enough documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, int] = {}
        held, rows = [], 0
        for batch in batches:
            for block in batch.column("block").to_pylist():
                t, names = _unpack(block)
                number = np.array([groups.setdefault(n, len(groups)) for n in names], np.int64)
                held.append(t.set_column(0, "g", pa.array(number[t["g"].to_numpy()])))
                rows += t.num_rows
                if rows > _HELD_ROWS:
                    held = [_merged(held)]
                    rows = held[0].num_rows - _HELD_ROWS // 2      # what is distinct stays; merge again after half as much
        if not held:
            return
        t, names = _merged(held).combine_chunks(), list(groups)
        lang_of = {lang: i for i, lang in enumerate(dict.fromkeys(n[0] for n in names))}
        coded = t["item"].combine_chunks().dictionary_encode()
        g = t["g"].to_numpy()
        term = np.array([lang_of[n[0]] for n in names])[g] * len(coded.dictionary) + coded.indices.to_numpy().astype(np.int64)
        distinct, docs = _summed(term, t["docs"].to_numpy())
        t = t.filter(pa.array(docs[np.searchsorted(distinct, term)] >= min_docs))
        for b in t.combine_chunks().to_batches(max_chunksize=1 << 16):
            at = b.column("g")
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in names]).take(at), pa.array([n[1] for n in names]).take(at),
                 b.column("item").cast(pa.binary()).cast(pa.string()), b.column("n")], ["lang", "source", "term", "n"])
    return run


def _small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has few rows; ``df`` must be written already."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _under(rows: DataFrame, kept: DataFrame, length: int) -> DataFrame:
    """The rows whose item begins with a kept prefix of their language."""
    return rows.withColumn("_head", F.substring("item", 1, length)).join(
        _small(kept.withColumnsRenamed({"item": "_head"})), ["lang", "_head"], "left_semi").drop("_head")


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, levels: tuple[int, ...] = LEVELS,
                created: list[str] | None = None) -> DataFrame:
    """(lang, source, term, n): occurrences by source of every term that ``min_docs`` documents of its language hold.

    A table is written to the shared folder; its path goes to ``created`` and may be deleted once the result is used.
    """
    spark, created = docs.sparkSession, [] if created is None else created
    path = scratch_path(spark, "prefix-counts")
    created.append(path)
    docs.mapInArrow(_counts(levels), _COUNTED).write.partitionBy("level").parquet(path)
    counted = spark.read.schema(_COUNTED).parquet(path)
    kept, length = None, 0
    for level in levels:
        rows = counted.filter(F.col("level") == level).select("lang", "item", "docs")
        rows = rows if kept is None else _under(rows, kept, length)
        kept, length = pinned(rows.groupBy("lang", "item").agg(F.sum("docs").alias("docs"))
                              .filter(F.col("docs") >= min_docs).select("lang", "item")), level
    shared = None if kept is None else spark.sparkContext.broadcast(_bit_table(kept).tobytes())
    parts = n_parts(spark)
    blocks = counted.filter("level = 0").select("block")
    return (blocks.mapInArrow(_split(parts, length, shared), _SPLIT).repartitionById(parts, F.col("part")).select("block")
            .mapInArrow(_kept_of_part(min_docs), "lang string, source string, term string, n long"))


# ----------------------------------------------------------------------------- divergence

def _p(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 1) / total); counts whose product passes a long go by decimals."""
    wide = (F.lit(PER_MILLIARD).cast("decimal(38,0)") * (count + 1).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.lit(1).cast("long") + F.when(
        count < 9 * PER_MILLIARD, F.call_function("div", F.lit(PER_MILLIARD).cast("long") * (count + 1), total)).otherwise(
        F.call_function("div", wide, total.cast("decimal(20,0)")))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (lang, the sources that have a term with their p and p of no occurrence) -> per pair of sources, what
    their common terms add beyond what the histogram gives."""
    def f(p, q):
        return (p - q) * (p - q) // q

    for batch in batches:
        entries = batch.column("s").flatten()
        if not len(entries):
            continue
        size = batch.column("s").value_lengths().to_numpy()
        term = np.repeat(np.arange(batch.num_rows), size)
        begin = np.r_[0, np.cumsum(size)]
        langs, sources = batch.column("lang").dictionary_encode(), entries.field("source").dictionary_encode()
        who, wide = sources.indices.to_numpy().astype(np.int64), len(sources.dictionary)
        lang = langs.indices.to_numpy().astype(np.int64)[term] * wide
        p, none = (entries.field(k).to_numpy().astype(np.int64) for k in ("p", "p0"))
        partners = size[term]
        upto = np.cumsum(partners)
        keys, values, lo = [], [], 0
        while lo < len(entries):        # some left sides at a time, with all their partners
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + _PAIRS, side="right")))
            left = np.repeat(np.arange(lo, hi), partners[lo:hi])
            right = np.arange(len(left)) - np.repeat(upto[lo:hi] - partners[lo:hi] - (upto[lo - 1] if lo else 0), partners[lo:hi])
            right += begin[term[left]]
            left, right = left[left != right], right[left != right]
            add = f(p[left], p[right]) - f(p[left], none[right]) - f(none[left], p[right]) + f(none[left], none[right])
            key, total = _summed((lang[left] + who[left]) * wide + who[right], add)
            keys.append(key)
            values.append(total)
            lo = hi
        key, total = _summed(np.concatenate(keys), np.concatenate(values))
        yield pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array(key // wide // wide)), sources.dictionary.take(pa.array(key // wide % wide)),
             sources.dictionary.take(pa.array(key % wide)), pa.array(total, pa.int64())], ["lang", "source", "item", "value"])


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("terms").alias("terms_b"))
    pairs = groups.join(_small(other), "lang").filter("source != item")
    lone = F.when(F.col("v") > 0, (F.col("v") - F.col("terms") - F.col("terms_b")) * _f(F.col("p0"), F.col("q0"))).otherwise(0)
    base = pairs.select("lang", "source", "item", lone.cast("decimal(38,0)").alias("value"))

    histogram = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    one = histogram.join(_small(groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))), "lang").filter("source != item")
    there = one.groupBy("lang", "source", "item").agg(F.sum(F.col("times") * _f(F.col("p"), F.col("q0")).cast("decimal(38,0)")).alias("there"),
                                                      F.sum(F.col("times") * _f(F.col("q0"), F.col("p")).cast("decimal(38,0)")).alias("back"))
    there = there.select("lang", F.explode(F.array(
        F.struct(F.col("source").alias("source"), F.col("item").alias("item"), F.col("there").cast("decimal(38,0)").alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").cast("decimal(38,0)").alias("value")))).alias("e")
                          ).select("lang", "e.*")

    by_term = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("s"))     # as many as sources at most
    both = (by_term.select("lang", "s").mapInArrow(_shared_terms, "lang string, source string, item string, value long")
            .withColumn("value", F.col("value").cast("decimal(38,0)")))
    return base.union(there).union(both).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """documents (text, lang, source) -> lang, source, part, item, value, rank: pairs of sources, and top terms of each."""
    spark, created = docs.sparkSession, []
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = kept_counts(rows, min_docs, levels, created)
    path = scratch_path(spark, "divergence")
    created.append(path)
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)

    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    langs = whole.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    zero = F.lit(0).cast("long")
    groups = (rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("v", "total", "terms", "total_lang")]))
    groups = pinned(groups.withColumn("p0", F.when(F.col("v") > 0, _p(zero, F.col("total") + F.col("v")))))

    shares = counts.join(_small(groups.select("lang", "source", "v", "total", "total_lang", "p0")), ["lang", "source"]).withColumn(
        "p", _p(F.col("n"), F.col("total") + F.col("v")))
    pairs = _pairs(shares.select("lang", "source", "term", "p", "p0"), groups.select("lang", "source", "v", "p0", "terms"))

    q = _p(F.col("n_lang"), F.col("total_lang") + F.col("v"))
    terms = (shares.join(whole, ["lang", "term"]).withColumn("q", q).filter("p > q")
             .select("lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value")))
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [part.withColumn("rank", F.row_number().over(falling)) for part in (pairs, terms)]
    result = pinned(ranked[0].withColumn("part", F.lit("pair")).unionByName(
        ranked[1].filter(F.col("rank") <= top).withColumn("part", F.lit("term")))
        .select("lang", "source", "part", "item", "value", "rank"))
    for made in created:
        delete_path(spark, made)
    return result


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}') AS t,
       coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
vl AS (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM k GROUP BY lang),
ng AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT ng.lang, ng.source, k.term, coalesce(c.n, 0) AS n,
        1 + ({PER_MILLIARD}::HUGEINT * (coalesce(c.n, 0) + 1)) // (total + v) AS p,
        1 + ({PER_MILLIARD}::HUGEINT * (n_lang + 1)) // (total_lang + v) AS q
      FROM ng JOIN vl USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = ng.lang AND c.source = ng.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
