import corpus_pipeline as pipeline
from sensorlake.llm import mixing
from tests.llm import brute
from tests.llm.conftest import ODD, SF, plain


def values(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stages_against_plain_versions(spark, tables):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    columns = frame.columns
    kept = pipeline.identify(spark, frame, SF)
    assert kept.columns == columns
    rows = [(r["doc_id"], r["text"]) for r in tables("documents")]
    assert sorted(values(kept)) == sorted(r for r in rows if any(map(str.isalpha, r[1])))

    frame, rows = kept, values(kept)
    kept = pipeline.near_duplicates(spark, frame, SF)
    first = {d: c for d, _, c in brute.simhash(rows)}
    assert kept.columns == columns
    assert sorted(values(kept)) == sorted(r for r in rows if first[r[0]] == r[0])

    rows = values(kept)
    clean = pipeline.decontaminate(spark, kept, SF)
    items = [i["text"] for i in tables("benchmark")]
    hit = {d for d, t in rows for i in items
           if len(set(t.lower().split()) & set(i.lower().split())) > len(i.split()) / 3 and brute.alignment(t, i) >= 0.8 - 1e-9}
    assert clean.columns == columns and hit
    assert sorted(values(clean)) == sorted(r for r in rows if r[0] not in hit)

    mixed = pipeline.mix(spark, clean, SF)
    assert mixed.columns == columns
    drawn = {r.doc_id: r.copies for r in mixing.copies(clean).collect()}
    assert sorted(values(mixed)) == sorted(r for r in values(clean) for _ in range(drawn[r[0]]))
    assert pipeline.shard(spark, mixed, SF).columns == [*columns, "shard"]


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert plain(map(list, pipeline.run(spark, SF).collect())) == plain(map(list, docs.collect()))


def test_odd_rows_pass_every_stage(spark, docs):
    frame = docs(ODD)
    for name, stage in pipeline.STAGES:
        out = stage(spark, frame, SF)
        assert set(out.columns) == set(frame.columns), name
        assert out.count() >= 1, name
        assert stage(spark, docs([]), SF).count() == 0, name
    once = pipeline.near_duplicates(spark, frame, SF).collect()
    exp = {c for _, _, c in brute.simhash([(r["doc_id"], r["text"]) for r in ODD])}
    assert sorted(r.doc_id for r in once) == sorted(exp)


CLASHING = ["score", "lang_pred", "ambiguous", "shard", "_row", "_key", "_tie", "copies", "size", "group", "th", "a b.c", "_rest", "ticket", "_g", "_place"]


def test_columns_of_any_name_pass_every_stage(spark, tables):
    rows = [r for r in tables("documents") if r["doc_id"] % 3 == 0]
    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], *[f"{c}-{r['doc_id']}" for c in CLASHING]) for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHING))
    for name, stage in pipeline.STAGES:
        frame = stage(spark, frame, SF)
        assert sorted(frame.columns) == sorted([*["doc_id", "text", "lang", "source", "n_chars"], *CLASHING]), name
        got = frame.collect()
        assert got, name
        for r in got:
            assert all(r[c] == f"{c}-{r.doc_id}" for c in CLASHING if (name, c) != ("shard", "shard")), name
    assert all(0 <= r["shard"] < 24 for r in got)


def test_rows_that_differ_beside_the_text_give_the_same_rerun(spark, tables):
    rows = [(r["doc_id"] // 4, r["text"] if r["doc_id"] % 5 else "one text that many rows share, under ids of their own", lang, f"s{k}")
            for r in tables("documents")[:60] for k, lang in enumerate(["en", "de", None])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()
    for stage in (pipeline.near_duplicates, pipeline.mix):
        first = plain(map(list, stage(spark, frame.repartition(1), SF).collect()))
        for n in (3, 7):
            assert plain(map(list, stage(spark, frame.repartition(n), SF).collect())) == first
