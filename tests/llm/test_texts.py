"""Operators on texts against plain versions, on the smallest tables and on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import decontam, kneser, language, mixing, packed, pii, sharding, simhash, suffixes
from tests.llm import brute
from tests.llm.conftest import ODD, SF, plain


def pairs(rows):
    return [(r.get("doc_id"), r.get("text")) for r in rows]


def test_suffixes_on_documents(spark, tables):
    got = suffixes.op2_suffixes(spark, SF).collect()
    assert plain(map(list, got)) == plain(map(list, brute.removed(pairs(tables("documents")))))


def test_suffixes_with_hot_grams_on_documents(spark, tables, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "_STEP", 5000)
    got = suffixes.op2_suffixes(spark, SF).collect()
    assert plain(map(list, got)) == plain(map(list, brute.removed(pairs(tables("documents")))))


def test_suffixes_on_odd_rows(docs):
    got = suffixes.dedup(docs(ODD)).drop("kept").collect()
    assert plain(map(list, got)) == plain(map(list, brute.removed(pairs(ODD))))
    assert suffixes.dedup(docs([])).count() == 0
    kept = {r.doc_id: r.kept for r in suffixes.dedup(docs([{"doc_id": 1, "text": "x" * 40 + "y" * 40},
                                                           {"doc_id": 2, "text": "z" + "x" * 40 + "y" * 40 + "q"}]),
                                                     with_kept=True).collect()}
    assert kept == {1: b"x" * 40 + b"y" * 40, 2: b"zq"}


def test_loser_tree_merges_with_known_prefixes():
    runs = [sorted({bytes([97 + i % 3]) * (i % 7) + bytes([98]) * (i * j % 5) for i in range(40)}) for j in range(1, 6)] + [[]]
    prefixes = [suffixes.front_coded(r)[0].tolist() if r else [] for r in runs]
    out = list(suffixes.merged(runs, prefixes))
    strings = [runs[r][i] for r, i, _ in out]
    assert strings == sorted(s for r in runs for s in r)
    for (_, _, common), a, b in zip(out[1:], strings, strings[1:]):
        assert common == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_front_coding_round_trip():
    strings = sorted({b"", b"a", b"ab", b"ab\0", b"abc", b"b\0\0", b"b\0\0c"})
    prefix, length, tail = suffixes.front_coded(strings)
    assert suffixes.front_decoded(prefix.tolist(), length.tolist(), tail) == strings


def test_sorted_suffixes_and_merged_runs_against_plain_sorting(monkeypatch):
    rnd = random.Random(5)
    for trial in range(60):
        letters = rnd.choice([b"ab", b"\0a", bytes(range(256))])
        monkeypatch.setattr(suffixes, "_STEP_COST", rnd.choice([0, 1, 100]))
        monkeypatch.setattr(suffixes, "_TREES", rnd.choice([1, 8, 1 << 16]))
        runs = [sorted({bytes(rnd.choices(letters[:2], k=rnd.choice([3, 8]))) + bytes(rnd.choices(letters, k=rnd.randint(0, 20)))
                        for _ in range(rnd.randint(1, 60))}) for _ in range(rnd.randint(1, 9))]
        prefix, length, tail = zip(*map(suffixes.front_coded, runs))
        prefix, length, strings = np.concatenate(prefix), np.concatenate(length), [s for r in runs for s in r]
        chars = suffixes.front_decoded_rows(prefix, length, b"".join(tail), int(length.max()) // 8 * 8 + 8)
        assert [row[:n].tobytes() for row, n in zip(chars, length)] == strings
        order, common = suffixes.merged_runs(chars.view(">u8").astype(np.uint64), length, prefix,
                                             np.repeat(np.arange(len(runs)), list(map(len, runs))))
        assert sorted(order.tolist()) == list(range(len(strings)))
        out = [strings[i] for i in order]
        assert out == sorted(strings)
        for n, a, b in zip(common[1:], out, out[1:]):
            assert n == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        data = np.frombuffer(bytes(rnd.choices(letters[:2], k=400)) + bytes(8), np.uint8)
        first, size, key = np.array([(rnd.randint(0, 380), rnd.randint(1, 20), rnd.randint(0, 3)) for _ in range(rnd.randint(1, 200))]).T
        by, new = suffixes.sorted_suffixes(key.astype(np.uint64), data, first, size)
        found = [(int(key[i]), data[first[i]:first[i] + size[i]].tobytes()) for i in by]
        assert found == sorted(found)
        assert new.tolist() == [True] + [a != b for a, b in zip(found, found[1:])]


def test_a_bucket_compares_suffixes_with_those_of_their_gram_only(monkeypatch):
    """64 runs of one bucket; every gram stands in two of them, with different bytes around one common window."""
    calls, plain_one = [], suffixes._first_difference
    monkeypatch.setattr(suffixes, "_first_difference", lambda *a: calls.append(1) or plain_one(*a))
    rnd, runs = random.Random(6), [[] for _ in range(64)]
    windows = {}
    for g in range(3200):
        key, window = (7 << 40 | rnd.getrandbits(40)).to_bytes(8, "big"), rnd.randbytes(suffixes.WINDOW)
        for doc, r in enumerate(rnd.sample(range(64), 2)):
            before = rnd.randint(0, 5)
            runs[r].append((key + b"01"[doc:doc + 1] * before + window + b"23"[doc:doc + 1] * rnd.randint(0, 5), doc))
            windows[r, runs[r][-1][0]] = before, doc
    rows = []
    for number, run in enumerate(map(sorted, runs)):
        prefix, length, tail = suffixes.front_coded([s for s, _ in run])
        small = {c: pa.compress(v.astype(np.uint8).tobytes(), "zstd", asbytes=True) for c, v in (("prefix", prefix), ("length", length))}
        rows.append({"bucket": 7, "block": number, "n": len(run), **small, "tail": pa.compress(tail, "zstd", asbytes=True),
                     "tail_bytes": len(tail), "least": packed.encoded(np.array([doc for _, doc in run]))})
        runs[number] = run
    found = set()
    for r in suffixes._merge_bucket(7, rows):
        for i, span, least in zip(packed.decoded_sorted(r["entry"], r["n"]), packed.decoded(r["windows"], r["n"], np.int64),
                                  packed.decoded(r["least"], r["n"], np.int64)):
            found.add((r["block"], runs[r["block"]][int(i)][0], int(span) >> 8, int(span) & 255, int(least)))
    assert found == {(r, s, before, 1, 0) for (r, s), (before, doc) in windows.items() if doc}
    assert len(calls) < 6400            # 64 runs in one tree: about six a suffix


def test_simhash_on_documents(spark, tables):
    got = simhash.op3_simhash(spark, SF).collect()
    assert plain(map(list, got)) == plain(map(list, brute.simhash(pairs(tables("documents")))))


def test_simhash_on_odd_rows(docs):
    got = simhash.near_duplicates(docs(ODD)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert plain(map(list, got)) == plain(map(list, brute.simhash(pairs(ODD))))
    assert simhash.near_duplicates(docs([])).count() == 0


def test_anchors_meet_for_every_pair_within_three_bits(spark, monkeypatch):
    import itertools
    import random
    draw = random.Random(3)
    bases = [draw.getrandbits(64) for _ in range(6)]
    prints = {b ^ sum(1 << i for i in draw.sample(range(64), draw.randint(0, 4))) for b in bases for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    exp = brute.roots(signed, [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3])
    for hot in (simhash.HOT, 2):        # also with split anchors
        monkeypatch.setattr(simhash, "HOT", hot)
        got = {r.node: r.root for r in simhash.link_components(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
        assert {p: got.get(p, p) for p in signed} == {p: min(exp[p]) for p in signed}


def near(a, b):
    return abs(a - b) <= 1e-7 * max(1, abs(b))


def check_scores(got, exp):
    got, exp = (sorted(map(tuple, x), key=repr) for x in (got, exp))
    assert [g[:5] for g in got] == [e[:5] for e in exp]
    assert all(near(g[5], e[5]) and near(g[6], e[6]) for g, e in zip(got, exp))


def test_kneser_ney_on_documents(spark, tables):
    got = kneser.op8_kneser_ney(spark, SF)
    check_scores(got.collect(), brute.kneser_ney(pairs(tables("documents"))))
    held = got.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]            # the model beats single words on texts it hasn't seen


def test_kneser_ney_on_odd_rows_and_its_tables(docs):
    scores, grams, by_word = kneser.kneser_ney(docs(ODD))
    check_scores(scores.collect(), brute.kneser_ney(pairs(ODD)))
    assert grams.agg(F.sum("n")).first()[0] > 0 and by_word.agg(F.sum("n")).first()[0] > 0
    assert kneser.kneser_ney(docs([]))[0].count() == 0
    only_held = kneser.kneser_ney(docs([{"doc_id": next(i for i in range(99) if kneser.held_out(i)), "text": "a b"}]))[0].first()
    assert only_held.train_tokens == 0 and only_held.score == 0 and only_held.base_score == 0


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_kneser_ney_of_any_order(docs, tables, order):
    rows = [{"doc_id": r["doc_id"], "text": r["text"][:1500]} for r in tables("documents") if r["doc_id"] % 3 == 0] + ODD
    scores, *model = kneser.kneser_ney(docs(rows), order)
    got, exp = (sorted(x, key=repr) for x in ([(r.doc_id, r.score) for r in scores.collect()], brute.kneser_ney_of_order(pairs(rows), order)))
    assert [g[0] for g in got] == [e[0] for e in exp] and all(near(g[1], e[1]) for g, e in zip(got, exp))
    assert len(model) == order
    with pytest.raises(ValueError):
        kneser.kneser_ney(docs(rows), 0)


def test_a_stored_model_scores_other_texts(spark, docs, tables, tmp_path):
    rows = [{"doc_id": r["doc_id"], "text": r["text"][:1500]} for r in tables("documents") if r["doc_id"] % 3 == 0]
    others = [{"doc_id": 5000 + r["doc_id"], "text": r["text"][:800]} for r in tables("documents") if r["doc_id"] % 3 == 1] + ODD
    tables_ = kneser.kneser_ney(docs(rows), 3)[1:]
    for i, t in enumerate(tables_):
        t.write.parquet(str(tmp_path / str(i)))
    stored = [spark.read.parquet(str(tmp_path / str(i))) for i in range(3)]
    got = sorted(((r.doc_id, r.score) for r in kneser.score(docs(others), *stored).collect()), key=repr)
    exp = sorted(brute.kneser_ney_of_order(pairs(rows), 3, pairs(others)), key=repr)
    assert [g[0] for g in got] == [e[0] for e in exp] and all(near(g[1], e[1]) for g, e in zip(got, exp))
    same = sorted(((r.doc_id, r.score) for r in kneser.score(docs(rows), *stored).collect()), key=repr)
    assert all(near(a[1], b[1]) for a, b in zip(same, sorted(brute.kneser_ney_of_order(pairs(rows), 3), key=repr)))
    assert kneser.score(docs([]), *stored).count() == 0
    nothing = kneser.kneser_ney(docs([]), 2)[1:]
    assert kneser.score(docs(ODD), *nothing).agg(F.min("score"), F.max("score")).first()[:] == (0.0, 0.0)


def test_language_on_held_out_documents(spark, tables):
    truth = {r["doc_id"]: r["lang"] for r in tables("documents")}
    rows = language.op6_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("labels", [["en"], ["en", "de"], ["en", "de", "fr", "es"]])
def test_language_against_a_plain_version(docs, tables, labels):
    rows = [{"doc_id": r["doc_id"], "text": r["text"][:600], "lang": r["lang"] if r["lang"] in labels else None} for r in tables("documents")] + [
        {**r, "lang": None} for r in ODD]
    got = language.predict(docs(rows), language.learn(docs(rows)), {"doc_id": "long", "text": "string"}).collect()
    exp = brute.language([(r["text"], r["lang"]) for r in rows], [r["text"] for r in rows])
    key = lambda doc, text: (str(doc), str(text))
    got = {key(r.doc_id, r.text): (r.lang_pred, r.score, r.ambiguous) for r in got}
    for row, (lang, score, close) in zip(rows, exp):
        mine = got[key(row["doc_id"], row["text"])]
        assert abs(mine[1] - score) < 1e-3, row
        if abs(score - 0.5) > 0.01:
            assert mine[0] == lang
        assert mine[2] == close or abs(2 * score - 1 - 0.02) < 2e-3 or len(labels) > 2


def test_ties_between_codewords_go_to_the_first_label(docs):
    rows = [{"doc_id": 1, "text": "abc abc", "lang": "xx"}, {"doc_id": 2, "text": "abc abc", "lang": "aa"}]
    got = language.predict(docs(rows), language.learn(docs(rows)), {"doc_id": "long"}).collect()
    assert {(r.lang_pred, r.score, r.ambiguous) for r in got} == {("aa", 0.5, True)}


def test_language_on_odd_rows(spark, docs):
    frame = docs(ODD)
    rows = language.predict(frame, language.learn(frame), {"doc_id": "long", "text": "string"}).collect()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 5, 10}
    assert {r.lang_pred for r in rows if r.doc_id in (8, -9)} == {"de"}
    empty = docs([])
    assert language.predict(frame, language.learn(empty), {"doc_id": "long"}).filter("lang_pred != 'und' or score != 0").count() == 0
    assert language.predict(empty, language.learn(frame), {"doc_id": "long"}).count() == 0


def test_language_decoding_takes_the_nearest_codeword():
    for k in (2, 4, 6, 9):
        code = language.codewords(k)
        distances = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert min(distances) >= 1 and (k < 4 or min(distances) >= 3)     # room to correct a wrong bit


def test_personal_data_on_documents_and_odd_rows(spark, docs, tables):
    for got, rows in ((pii.op10_pii(spark, SF), tables("documents")), (pii.find(docs(ODD)), ODD)):
        exp = sorted(brute.personal(r["text"]) for r in rows)
        if "base" in got.columns:
            assert sorted([tuple(s) for s in r.base] for r in got.collect()) == exp
            assert all(set(r.base) <= set(r.spans) for r in got.collect())
            continue
        names = list(brute.PERSONAL)
        by_id = {r.doc_id: r for r in got.collect()}
        for row in rows:
            spans = brute.personal(row["text"])
            joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
            mine = by_id[row["doc_id"]]
            assert mine.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
            assert set(filter(None, joined.split(","))) <= set(mine.spans.split(","))
    assert pii.find(docs([])).count() == 0


@pytest.mark.parametrize("text", [
    "a@b.c.d@e.f", "x.@y..z@q.r", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0003.4", "4111111111111111-4111111111111111",
    "+1 2 3+4 (5) 6-7.8 9 0 1 2 3", "4111 1111 1111 11114", "0000000000000000", "é@ü.de a+b@c-.d-", "+12345678901234567890 +1234567890",
])
def test_personal_data_patterns(docs, text):
    got = pii.find(docs([{"doc_id": 1, "text": text}])).first()
    assert [tuple(s) for s in got.base] == brute.personal(text)


def test_wider_spans_are_learned_and_redacted(docs):
    rows = [{"doc_id": i, "text": f"call tel +1 (212) 555-01{i % 90 + 10} or tel (212) 555-01{i % 90 + 10}, mail a{i}@b.com"} for i in range(80)]
    found = pii.find(docs(rows))
    got = docs(rows).join(found, "doc_id").select(pii.redact(F.col("text"), F.col("spans")).alias("t"), "base", "spans").collect()
    assert all(r.t.startswith("call tel [phone] or tel ") and r.t.endswith("mail [email]") for r in got)


WIDER = [("email", "mail", "ann.lee{i} (at) host{i} (dot) com"), ("phone", "tel", "(212) 555-01{d}"), ("ip", "", "10[.]20[.]{i}[.]7"),
         ("card", "card", "4222222222222"), ("phone", "tel", "212 555 01{d}"), ("email", "", "bob{i} @ mail.example.org"),
         ("ip", "server", "10 . 20 . {i} . 7"), ("card", "", "4111.1111.1111.1111")]
BASE = ["mail a{i}@b.com", "tel +1 (212) 555-01{d}", "host 10.20.{i}.7", "card 4111 1111 1111 1111"]
DECOYS = ["part 7. 1. 2. 3 on", "order 4222222222223 of", "look @ this. And", "serial 2024-1234-5678 ok"]


@pytest.mark.parametrize("share", [1, 2, 10])
def test_planted_wider_spans_are_found_and_redacted(docs, share):
    """Every ``share``-th document holds a wider span, a base span otherwise."""
    rows, planted = [], {}
    for i in range(160):
        kind, hint, value = WIDER[i // share % len(WIDER)]
        begin = f"note {DECOYS[i % 4]} then {hint} "
        if i % share == 0:
            value = value.format(i=i, d=i % 90 + 10)
            planted[i] = [(len(begin), list(brute.PERSONAL).index(kind), len(begin) + len(value))]
            text = f"{begin}{value}. Thanks, {i}"
        else:
            text = f"note {DECOYS[i % 4]} then " + BASE[i % 4].format(i=i, d=i % 90 + 10)
        rows.append({"doc_id": i, "text": text})
    found = {r.doc_id: r for r in pii.find(docs(rows)).collect()}
    for row in rows:
        i, base = row["doc_id"], brute.personal(row["text"])
        assert [tuple(s) for s in found[i].base] == base
        assert [tuple(s) for s in found[i].spans] == sorted(base + planted.get(i, [])), row["text"]
    names = list(brute.PERSONAL)
    red = docs(rows).join(pii.find(docs(rows)), "doc_id").select("doc_id", "text", pii.redact(F.col("text"), F.col("spans")).alias("t"))
    for r in red.collect():
        for a, k, b in planted.get(r.doc_id, []):
            assert r.t == f"{r.text[:a]}[{names[k]}]{r.text[b:]}"


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_the_trees_overrule_the_rule_where_values_pass_by_chance(docs):
    """Order numbers of 13 digits that begin with 4: one in ten passes Luhn, and by its form alone it would be a card.
    Card numbers of the same shape, after a word that says so, all pass."""
    draw, rows, cards, chance = random.Random(4), [], {}, []
    for i in range(600):
        number = "4" + "".join(draw.choice("0123456789") for _ in range(12))
        if i % 4 == 0:
            while not luhn(number):
                number = "4" + "".join(draw.choice("0123456789") for _ in range(12))
            begin = "paid with card "
            cards[i] = (len(begin), 2, len(begin) + 13)
        else:
            begin = draw.choice(["order number ", "shipment ", "our reference "])
            chance += [i] * luhn(number)
        rows.append({"doc_id": i, "text": f"{begin}{number} of {i % 7} items"})
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(docs(rows)).collect()}
    assert len(chance) > 25
    caught = sum(cards[i] in found[i] for i in cards)
    wrong = sum(bool(found[i]) for i in found if i not in cards)
    assert caught >= 0.9 * len(cards) and wrong <= 0.05 * caught     # recall and precision
    assert not any(found[i] for i in chance)


def test_the_label_is_no_function_of_the_features(docs):
    rows = [{"doc_id": i, "text": f"order {4222222222222 + i * 7} then card {4222222222222 + i * 3}, tel 212-555-{1000 + i}"} for i in range(200)]
    _, spans = pii.candidates(docs(rows))
    cells = spans.groupBy(*pii.FEATURES).agg(F.countDistinct("label").alias("kinds"))
    assert cells.filter("kinds > 1").count() > 0
    assert not {"valid", "form", "luhn"} & set(pii.FEATURES)


def test_one_written_out_address_alone(docs):
    got = pii.find(docs([{"doc_id": 1, "text": "ann (at) host (dot) com"}])).first()
    assert [tuple(s) for s in got.spans] == [(0, 0, 23)]


def test_contaminated_documents(spark, tables):
    items = tables("benchmark")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.op1_decontaminate(spark, SF).collect()}
    rows = [r for r in tables("documents") if len(r["text"]) < 4000]
    for row in rows[:120]:
        for item in items:
            if len(set(row["text"].lower().split()) & set(item["text"].lower().split())) < len(item["text"].split()) / 3:
                assert (row["doc_id"], item["item_id"]) not in got
                continue
            similarity = brute.alignment(row["text"], item["text"])
            key = (row["doc_id"], item["item_id"])
            assert (key in got) == (similarity >= 0.8 - 1e-9)
            assert key not in got or abs(got[key] - similarity) < 1e-9


def test_edited_copies_of_benchmark_items(spark, docs, tables):
    import random
    draw = random.Random(5)
    items = tables("benchmark")[:12]
    rows, hit = [], {}
    for i, item in enumerate(items):
        words = item["text"].split()
        for share in (0, 0.08, 0.15, 0.5):
            edited = [w if draw.random() >= share else f"zz{draw.randrange(999)}" for w in words]
            text = " ".join(["filler"] * 50 + edited + ["more"] * 700)
            key = len(rows)
            rows.append({"doc_id": key, "text": text})
            hit[key, item["item_id"]] = brute.alignment(text, item["text"])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs(rows), bench).collect()}
    assert {k for k, v in hit.items() if v >= 0.8 - 1e-9} == set(got)
    assert all(abs(got[k] - hit[k]) < 1e-9 for k in got)


def test_long_documents_against_alignment(spark, tables, docs):
    """Whole texts of 20,000 words: passages at the start, in the middle, at the very end, edited ones, and none."""
    draw = random.Random(8)
    items = tables("benchmark")[:6]
    vocabulary = sorted({w for r in tables("documents")[:40] for w in r["text"].split()})
    rows, hit = [], {}
    for i, at in enumerate([0, 9_000, 19_950, None, 12_000]):
        words = [draw.choice(vocabulary) for _ in range(20_000)]
        item = items[i % len(items)]["text"].split()
        if at is not None:
            copy = [w if i < 4 or draw.random() > 0.1 else "changed" for w in item]
            words[at:at + len(copy)] = copy
        rows.append({"doc_id": i, "text": " ".join(words)})
        for it in items:
            hit[i, it["item_id"]] = brute.alignment(rows[-1]["text"], it["text"])
    bench = spark.createDataFrame([(i["item_id"], i["text"], 1, 2, 3, "x") for i in items],
                                  "item_id long, text string, doc_id int, th int, seeds int, n_left string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs(rows), bench).collect()}
    assert {k for k, v in hit.items() if v >= 0.8 - 1e-9} == set(got) and len(got) >= 4
    assert all(abs(got[k] - hit[k]) < 1e-9 for k in got)


def test_copies_of_repetitive_items(spark, docs):
    line = "row row row your boat gently down the stream merrily".split()
    items = {1: line * 10, 2: "yes no no yes no".split() * 12, 3: [str(i * i % 10) for i in range(200)],
             4: [f"u{i}" for i in range(40)] + "and so say all of us".split() * 10}
    rows, hit = [], {}
    for item, words in items.items():
        for step in (0, 17, 7):
            copy = [f"zz{i}" if step and i % step == step // 2 else w for i, w in enumerate(words)]
            text = " ".join(["filler"] * 30 + copy + ["more"] * 30)
            hit[len(rows), item] = brute.alignment(text, " ".join(words))
            rows.append({"doc_id": len(rows), "text": text})
    assert min(hit.values()) >= 0.8
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs(rows), bench).collect()}
    assert set(got) == set(hit) and all(abs(got[k] - hit[k]) < 1e-9 for k in got)


def test_edited_copies_of_short_items(spark, docs):
    rows, hit, bench = [], {}, []
    for n in range(1, 20):
        words = [f"w{n}x{i}" for i in range(n)]
        bench.append((n, " ".join(words)))
        copies = [[w if i != k else "zz" for i, w in enumerate(words)] for k in range(n)]
        copies += [[x for i, w in enumerate(words) for x in ((w, "yy") if i % step == step - 1 else (w,))] for step in (2, 3, 4)]
        copies += [[w if i % step != step // 2 else "zz" for i, w in enumerate(words)] for step in (3, 4, 5)]
        for copy in [words, *copies]:
            text = " ".join(["filler"] * 5 + copy + ["more"] * 5)
            hit[len(rows), n] = brute.alignment(text, bench[-1][1])
            rows.append({"doc_id": len(rows), "text": text})
    frame = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs(rows), frame).collect()}
    assert set(got) == {k for k, v in hit.items() if v >= 0.8 - 1e-9} and all(abs(got[k] - hit[k]) < 1e-9 for k in got)


def test_edited_copies_of_an_item_of_common_words(spark, docs, monkeypatch):
    monkeypatch.setattr(decontam, "RARE_FLOOR", 2)
    texts = ["zz good to see you", "it is zz to see you again"] + ["it is good or"] * 30 + [f"oh so good to {i}" for i in range(30)]
    bench = spark.createDataFrame([(1, "is good to see you")], "item_id long, text string")
    got = {r.doc_id for r in decontam.contaminated(docs([{"doc_id": i, "text": f"{t} {i}"} for i, t in enumerate(texts)]), bench).collect()}
    assert got == {i for i, t in enumerate(texts) if brute.alignment(t, "is good to see you") >= 0.8 - 1e-9}


def test_contamination_on_odd_rows(spark, docs):
    bench = spark.createDataFrame([(1, "quick BROWN fox jumps over the lazy"), (2, None), (3, ""), (4, "straße"),
                                   (1, "quick BROWN fox jumps over the lazy"), (None, "band plays on")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(ODD), bench).collect()}
    assert got == {(d, i) for d in (None, 3, 4) for i in (1, None)} | {(8, 4), (-9, 4)}
    assert decontam.contaminated(docs([]), bench).count() == 0
    assert decontam.contaminated(docs(ODD), bench.limit(0)).count() == 0


def mix_rows(docs_frame):
    return mixing.copies(docs_frame).collect()


def test_mixing_follows_its_targets(spark, docs):
    for rows in (mixing.op4_mix(spark, SF).collect(), [r for r in mix_rows(docs(ODD))]):
        taken, target, largest, of = {}, {}, {}, {}
        for r in rows:
            taken[r.target, r.source_size] = taken.get((r.target, r.source_size), 0) + r.taken
            largest[r.target, r.source_size] = max(largest.get((r.target, r.source_size), 0), r.size)
            assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size + 1e-6
        for key, words in taken.items():
            assert abs(words - key[0]) <= 3 * largest[key] + 1
    assert mixing.copies(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0


def test_mixed_rows_are_emitted_as_often_as_drawn(docs):
    frame = docs(ODD)
    drawn = {}
    for r in mixing.copies(frame).collect():
        drawn[r.doc_id, r._source] = drawn.get((r.doc_id, r._source), 0) + r.copies
    out = mixing.mix(frame)
    assert out.columns == frame.columns
    emitted = {}
    for r in out.collect():
        key = (r.doc_id, "n" if r.source is None else "s" + r.source)
        emitted[key] = emitted.get(key, 0) + 1
    assert emitted == {k: v for k, v in drawn.items() if v}
    assert plain(map(list, mixing.mix(frame).collect())) == plain(map(list, out.collect()))


def test_sharding_law(spark, docs, tables):
    for frame, rows in ((sharding.op5_shard(spark, SF), tables("documents")), (sharding.assign(docs(ODD)), ODD)):
        got = frame.collect()
        assert len(got) == len(rows)
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
            assert 0 <= r.shard < 24 and (r.grown_shard == r.shard or r.grown_shard == 24)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        exp = sorted((len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in rows)
        assert sorted((r.size, r.text_crc32) for r in got) == exp
        by_id = {}
        for r in got:
            assert by_id.setdefault(r.doc_id, r.shard) == r.shard
    assert sharding.assign(docs([])).count() == 0 and sharding.place(docs([])).count() == 0


def test_weights_move_rows_into_their_subtree_only(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    base, heavy = sharding.tree(24), sharding.tree(24, {5: 3.0})
    rows = ids.select(sharding.shard_of(F.col("k"), base).alias("a"), sharding.shard_of(F.col("k"), heavy).alias("b"))
    moved = rows.filter("a != b")
    assert moved.filter("b != 5").count() == 0
    share = rows.filter("b = 5").count() / 20000
    assert abs(share - 3 / 26) < 0.01


def test_placement_against_a_plain_version(spark):
    from tests.llm import brute
    keys = [None, "", "7", "é", *map(str, range(3000))]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    for n, weights in ((24, None), (25, None), (30, {3: 2.5, 27: 0.5}), (24, {5: 0.25, 6: 4.0}), (1, None), (7, None)):
        got = [r.s for r in frame.select(sharding.shard_of(F.col("k"), sharding.tree(n, weights)).alias("s")).collect()]
        assert got == [brute.shard(k, n, weights or {}) for k in keys], (n, weights)
        if n >= 24:
            total = sum((weights or {}).get(i, 1.0) for i in range(n))
            for i in (0, 3, 5, 6):
                assert abs(got.count(i) / len(keys) - (weights or {}).get(i, 1.0) / total) < 0.02


@pytest.mark.parametrize("level", ["shard", "rack", "region"])
def test_added_weight_moves_rows_into_its_subtree_only(spark, level):
    """One shard, all shards of a rack, all of a region grow: rows move in there, to each in proportion, and nowhere else."""
    nodes = sharding.tree(24).nodes
    grown = {"shard": [9], "rack": list(nodes[1][2]), "region": [s for rack in nodes[0].values() for s in rack]}[level]
    ids = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    rows = ids.select(sharding.shard_of(F.col("k"), sharding.tree(24)).alias("a"),
                      sharding.shard_of(F.col("k"), sharding.tree(24, {s: 2.0 for s in grown})).alias("b")).cache()
    assert rows.filter("a != b").filter(~F.col("b").isin(grown)).count() == 0
    share = rows.filter(F.col("b").isin(grown)).count() / 20000
    assert abs(share - 2 * len(grown) / (24 + len(grown))) < 0.015
    by_shard = {r["b"]: r["count"] for r in rows.filter(F.col("b").isin(grown)).groupBy("b").count().collect()}
    assert len(by_shard) == len(grown) and max(by_shard.values()) < 1.35 * min(by_shard.values())

