import math
import random
import re
from collections import Counter

import numpy as np

from sensorlake.llm import rules
from tests.llm.conftest import ODD, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = re.findall(r"[A-Za-z\u0080-\U0010FFFF]", text)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_distinct_words": len(set(words)), "n_upper": len(re.findall("[A-Z]", text)), "n_letters": len(letters),
        "n_digits": len(re.findall("[0-9]", text)), "n_marks": len(re.findall(r"[!-/:-@\[-`{-~]", text)),
        "n_marked_words": sum(1 for w in words if re.search(r"[!-/:-@\[-`{-~]", w)), "n_ends": sum(1 for w in words if w[-1] in ".!?"),
    }


TEXTS = [None, "", "\n", "\n\n", "a", "a\n", "\na", "a\na", "a\r\na\n a\na", " \t\n \t\n", "a a a a", "a b c a b c d", "a b c\na b c\n", "é é é é",
         "日本語 の\n文 です 日本語 の 文", "*** | <b> #1 100%", "x" * 5000, "to be or not to be or not\n" * 400, "A! B. C? d", "\u0085   x"]


def random_texts(n=120, seed=6):
    draw = random.Random(seed)
    return ["".join(draw.choice(["a", "b", "ab", "é", "日本", "A!", "1", "#", " ", " ", "\n", "\t", "\r\n"]) for _ in range(draw.randrange(300)))
            for _ in range(n)]


def test_statistics_against_a_plain_version(spark, docs):
    texts = TEXTS + random_texts()
    got = rules.statistics(docs([{"doc_id": i, "text": t} for i, t in enumerate(texts)])).collect()
    assert len(got) == len(texts)
    for r in got:
        exp = plain_statistics(texts[r.doc_id])
        assert {k: r[k] for k in exp} == exp, repr(texts[r.doc_id])[:200]


def test_many_kinds_of_words_are_still_told_apart():
    """Numbers that no longer fit a long together are renumbered, not hashed."""
    draw = np.random.default_rng(0)
    a, b, c = (draw.integers(0, 5, 2000) for _ in range(3))
    wide = 1 << 40
    joined = rules._joined([(a * (wide // 8), wide), (b * (wide // 8), wide), (c, 5)])
    want = np.unique(np.column_stack([a, b, c]), axis=0, return_inverse=True)[1].ravel()
    assert len(set(zip(joined.tolist(), want.tolist()))) == len(set(joined.tolist())) == len(set(want.tolist()))


def plain_path(forest, root, row):
    node, depth = root, 0
    while forest.feature[node] >= 0:
        node = forest.child[node] + int(row[forest.feature[node]] > forest.split[node])
        depth += 1
    return forest.length[node]


def test_scores_are_path_lengths():
    draw = np.random.default_rng(2)
    rows = draw.standard_normal((500, 4))
    rows[0] = 40
    forest = rules.Forest(rows, trees=20, tree_rows=64)
    scores = forest.scores(rows)
    c = 2 * (math.log(63) + np.euler_gamma) - 2 * 63 / 64
    for i in (0, 1, 77):
        mean = sum(plain_path(forest, r, rows[i]) for r in forest.roots) / 20
        assert abs(scores[i] - 2 ** (-mean / c)) < 1e-12
    assert scores.argmax() == 0 and scores[0] > 0.6 > np.median(scores)
    same = rules.Forest(np.ones((9, 4)))
    assert len(set(same.scores(np.ones((3, 4))))) == 1      # nothing to split
    assert rules.Forest(np.ones((1, 4))).scores(np.zeros((2, 4))).tolist() == [1.0, 1.0]


def planted(n=400, seed=3):
    draw = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ba", "no", "ri", "te") for b in ("lo", "ma", "su") for c in ("", "n", "st", "ver")]
    good = lambda: " ".join(draw.choice(words) + draw.choice(["", "", "", "", ",", "."]) for _ in range(draw.randrange(60, 400)))
    rows, labels = [], []
    for i in range(n):
        bad = i % 8 == 0
        text = good()
        if bad:
            text = " ".join(w + draw.choice(["***", "$$", "|", "%%%"]) for w in text.split()) if i % 16 else text.upper().replace(" ", "!! ")
        rows.append({"doc_id": i, "text": text, "lang": "en", "source": "a"})
        if i % 3:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame([(i, q, 0, 5) for i, q in labels], "doc_id long, quality int, toxic int, score int")


def test_planted_bad_documents_go_and_clean_ones_stay(spark, docs):
    rows, labels = planted()
    got = {r.doc_id: r for r in rules.judged(docs(rows), label_frame(spark, labels)).collect()}
    bad = [i for i in range(400) if i % 8 == 0]
    assert not any(r.base_failed for r in got.values())
    assert sum(not got[i].kept for i in bad) >= 0.9 * len(bad)
    assert sum(got[i].kept for i in range(400) if i % 8) >= 0.97 * 350
    again = {r.doc_id: r.kept for r in rules.judged(docs(rows).repartition(7), label_frame(spark, labels).repartition(3)).collect()}
    assert again == {i: r.kept for i, r in got.items()}


def test_the_threshold_counts_all_labelled_rows(spark, docs):
    rows, labels = planted()
    known = rules.labelled(rules.statistics(docs(rows)), label_frame(spark, labels)).cache()
    scored = rules.scored(known, rules.grow(known))
    good = sorted(math.floor(r.score * rules.STEPS) for r in scored.filter("good and _half = 1").collect())
    for loss in (0.0, 0.02, 0.2, 1.0):
        cut = rules.threshold(scored, loss)
        reached = sum(g >= cut * rules.STEPS for g in good)
        assert reached <= loss * len(good) < sum(g >= cut * rules.STEPS - 1 for g in good) or cut == 0


def test_without_labels_only_the_base_rules_reject(spark, docs):
    rows, labels = planted(60)
    rows += [{"doc_id": 900, "text": "too short"}, {"doc_id": 901, "text": "again and again " * 60}]
    for some in ([], [(i, None) for i in range(60)], [(i, 1) for i in range(60)], [(None, 0), (None, 1)]):
        got = rules.judged(docs(rows), label_frame(spark, some)).collect()
        assert sorted(r.doc_id for r in got if not r.kept) == [900, 901]


def test_odd_rows(spark, docs):
    rows, labels = planted(100)
    rows += [{**r, "doc_id": r["doc_id"] and r["doc_id"] + 1000} for r in ODD]
    labels += [(1, 0), (1, 1), (1001, None), (1006, 1), (5000, 0)]
    got = rules.judged(docs(rows), label_frame(spark, labels)).collect()
    assert len(got) == len(rows)
    assert rules.judged(docs([]), label_frame(spark, labels)).count() == 0
    twice = [r for r in got if r.doc_id == 1003]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_whole_table(spark, tables):
    got = rules.op13_rules(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in tables("documents")}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    quality = {r["doc_id"]: r["quality"] for r in tables("labels")}
    for r in got:
        exp = plain_statistics(texts[r.doc_id])
        assert all(r[k] == exp[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    passed = [r for r in got if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in passed) >= 0.95 * len(passed)
