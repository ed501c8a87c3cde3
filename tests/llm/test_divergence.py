import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from sensorlake.llm import divergence
from tests.llm.conftest import ODD, SF

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows, min_docs=3, top=200):
    occurs, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        groups[lang].add(source)
        terms = TERM.findall((r["text"] or "").translate(FOLD))
        occurs[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        count = {s: {t: occurs[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(count[s][t] for s in sources) for t in kept}

        def share(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10 ** 9 * (n + 1) // total for t, n in c.items()}

        p, q = {s: share(count[s]) for s in sources}, share(whole)
        f = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pairs = [("pair", o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [("term", t, f(p[s][t], q[t])) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, limit in ((pairs, None), (terms, top)):
                ranked = sorted(part, key=lambda e: (-e[2], e[1].encode()))[:limit]
                out += [(lang, s, k, item, v, i + 1) for i, (k, item, v) in enumerate(ranked)]
    return sorted(out)


def corpus(n=150, seed=4):
    draw = random.Random(seed)
    vocabulary = ["to", "tom", "tomato", "tomatoes", "tomatoesandmore", "Über", "über", "ÜBER", "naïve", "naïveté", "日本", "日本語", "x" * 40,
                  "x" * 41, *(f"w{i}".translate({ord(str(d)): "abcdefghij"[d] for d in range(10)}) for i in range(400))]
    rows = []
    for i in range(n):
        words = [draw.choice(vocabulary[:draw.choice([5, 14, 60, 414])]) for _ in range(draw.randrange(40))]
        rows.append({"doc_id": i, "text": draw.choice([" ", "-", "1", "\n"]).join(w.upper() if draw.random() < 0.2 else w for w in words),
                     "lang": draw.choice(["en", "de", None, ""]), "source": draw.choice(["a", "b", "b", "b", "é", None])})
    return rows


def run(docs, **options):
    return sorted(map(tuple, divergence.audit(docs, **options).collect()))


def test_audit_against_a_plain_version(spark, docs):
    rows = corpus() + ODD + ODD[3:5]
    assert run(docs(rows)) == plain_audit(rows)


def test_levels_thresholds_and_partitions_make_no_difference(spark, docs, monkeypatch):
    rows = corpus(120, 9)
    exp = plain_audit(rows, 2, 7)
    assert run(docs(rows).repartition(5), min_docs=2, top=7) == exp
    assert run(docs(rows), min_docs=2, top=7, levels=()) == exp
    assert run(docs(rows), min_docs=2, top=7, levels=(1, 2, 3, 5, 9, 30)) == exp
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", 0)    # joins by shuffles
    assert run(docs(rows), min_docs=2, top=7) == exp


def test_prefixes_below_the_threshold_are_discarded(spark, docs):
    """At each level only what extends a kept prefix counts, and a document counts once however many terms share it."""
    def batch(rows):
        return pa.RecordBatch.from_pylist([{k: r[k] or "" for k in ("text", "lang", "source")} for r in rows])
    rows = [{"text": "tom tomato tomatoes", "lang": "en", "source": s} for s in ("a", "b")] + [{"text": "rare", "lang": "en", "source": "a"}]
    groups = {}
    counts = divergence._step_counts(batch(rows), (2, 4), groups)
    names = {v: k for k, v in groups.items()}
    found = {(names[g], item): (d, n) for part in counts for g, item, d, n in zip(part[0].tolist(), part[1].to_pylist(), part[2], part[3])}
    assert found[(2, "en", ""), b"to"] == (2, 0) and found[(4, "en", ""), b"toma"] == (2, 0) and found[(2, "en", ""), b"ra"] == (1, 0)
    assert found[(0, "en", "a"), b"tomato"] == (1, 1)
    kept = divergence.kept_counts(docs([{"doc_id": 1, **r} for r in rows]), 2).collect()
    assert sorted((r.source, r.term, r.n) for r in kept) == [(s, t, 1) for s in "ab" for t in ("tom", "tomato", "tomatoes")]


def test_tasks_that_hold_little_put_out_in_parts(spark, docs, monkeypatch):
    rows = corpus(60, 2)
    schema = pa.schema([("text", pa.string()), ("lang", pa.string()), ("source", pa.string())])
    batches = [pa.RecordBatch.from_pylist([{k: r[k] or "" for k in schema.names}], schema) for r in rows]

    def total(limit):
        monkeypatch.setattr(divergence, "_HELD_ROWS", limit)
        sums, blocks = Counter(), []
        for b in divergence._counts((2,))(iter(batches)):
            for r in b.to_pylist():
                if r["level"]:
                    sums[r["level"], r["lang"], r["item"]] += r["docs"]
                else:
                    blocks.append(r["block"])
                    t, names = divergence._unpack(r["block"])
                    for e in t.to_pylist():
                        sums[names[e["g"]], e["item"]] += e["docs"] * 1000 + e["n"]
        out = divergence._kept_of_part(2)(iter([pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])]))
        return sums, len(blocks), sorted(tuple(r.values()) for b in out for r in b.to_pylist())
    few, many = total(1 << 20), total(50)
    assert few[0] == many[0] and many[1] > few[1] and few[2] == many[2]


def test_the_bit_table_lets_every_kept_prefix_through(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FILTER_BITS", 15)
    kept = spark.createDataFrame([(lang, f"p{i}".encode()) for lang in ("en", "", "日本") for i in range(100)], "lang string, item binary")
    bits = divergence._bit_table(kept)
    rows = kept.collect()
    langs = sorted({r.lang for r in rows})
    at = divergence._hashes(pa.array([bytes(r.item) for r in rows]), np.array([langs.index(r.lang) for r in rows]), langs) >> np.uint64(49)
    assert all(bits[int(a) >> 3] >> (int(a) & 7) & 1 for a in at)
    assert np.unpackbits(bits).sum() == len(set(at.tolist())) > 250


def test_hashing_many_items_takes_little_memory(monkeypatch):
    """A block's items are hashed some at a time: the same hashes, and a few bytes a row at the most."""
    import tracemalloc

    items, group = pa.array([b"term%d" % i for i in range(400_000)], pa.large_binary()), np.arange(400_000) % 2
    monkeypatch.setattr(divergence, "_HASH", divergence.Hasher(12))
    tracemalloc.start()
    got = divergence._hashes(items, group, ["en", "de"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000
    lone = [divergence._hashes(items.slice(i, 1), group[i:i + 1], ["en", "de"])[0] for i in range(0, 400_000, 9_999)]
    assert got[::9_999].tolist() == [int(h) for h in lone]


def test_a_language_without_kept_terms_and_empty_tables(spark, docs):
    rows = [{"doc_id": i, "text": f"only{'abc'[i]}", "lang": "xx", "source": "abc"[i]} for i in range(3)]
    assert run(docs(rows)) == plain_audit(rows) and all(r[4] == 0 for r in plain_audit(rows))
    assert run(docs([])) == []
    assert run(docs([{"doc_id": 1, "text": None, "lang": None, "source": None}])) == []


def test_shares_of_counts_beyond_a_long(spark):
    from pyspark.sql import functions as F
    got = spark.range(1).select(divergence._p(F.lit(10 ** 17), F.lit(3 * 10 ** 17)).alias("p")).first().p
    assert got == 1 + 10 ** 9 * (10 ** 17 + 1) // (3 * 10 ** 17)


def test_whole_table_against_the_plain_version(spark, tables):
    assert sorted(map(tuple, divergence.op12_divergence(spark, SF).collect())) == plain_audit(tables("documents"))
