"""Plain, slow versions of the operators that SQL can't express."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def roots(nodes, links):
    """node -> the nodes of its component."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in nodes:
        if n not in out:
            found, todo = {n}, [n]
            while todo:
                new = near[todo.pop()] - found
                found |= new
                todo += new
            out |= dict.fromkeys(found, found)
    return out


def removed(rows, width=50):
    """(doc_id, text) -> op2's columns."""
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1 if key is not None else 0):
            part = data[i:i + width]
            first[part] = min(first.get(part, key), key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1 if key is not None else 0):
            if first[data[i:i + width]] < key:
                gone[i:i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text, shingle=3):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, bits=3):
    """(doc_id, text) -> doc_id, fingerprint, component_id."""
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    of = roots(distinct, [(a, b) for a, b in itertools.combinations(distinct, 2) if (a ^ b).bit_count() <= bits])
    ids = defaultdict(list)
    for (key, _), p in zip(rows, prints):
        if key is not None:
            ids[p].append(key)
    return [(key, f"{p:016x}", min((i for q in of[p] for i in ids[q]), default=None)) for (key, _), p in zip(rows, prints)]


def vectors(rows, cosine=0.98):
    """(vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    unit = []
    for _, v, label in rows:
        fine = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float64) / max(map(abs, v)) if fine else None
        unit.append(x / np.sqrt((x * x).sum()) if fine else None)
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
    degree = Counter(i for link in links for i in link)
    of = roots(range(len(rows)), links)
    out = []
    for i, (key, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in of[i] if rows[j][0] is not None]
        low = min(ids, default=None)
        out.append((key, degree[i], low, key == low))
    return out


def kneser_ney(rows):
    """(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = [WORD.findall(lower(t)) + [None] for _, t in rows]
    held = [zlib.crc32(b"" if key is None else str(key).encode()) % 10 == 0 for key, _ in rows]
    plain, pairs = Counter(), Counter()
    for words, h in zip(texts, held):
        if not h:
            plain.update(words)
            pairs.update(zip([("start",), *words], words))
    total, size = sum(plain.values()), len(plain) + 1
    before, uses, followers = Counter(), Counter(), defaultdict(lambda: [0, 0, 0, 0])
    for (v, w), c in pairs.items():
        before[w] += 1
        uses[v] += c
        followers[v][min(c, 3)] += 1

    def cuts(counts):
        n = Counter(counts)
        if not (n[1] and n[2] and n[3]):
            return [0, .5, 1, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(x, 0), i) for i, x in enumerate([0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]])]

    two, one, types = cuts(pairs.values()), cuts(before.values()), len(pairs)
    spare = sum(one[min(c, 3)] for c in before.values()) / types if types else 0

    def p_one(w):
        return (max(before[w] - one[min(before[w], 3)], 0) / types if types else 0) + (spare / size if types else 1 / size)

    def p_two(v, w):
        if not uses[v]:
            return p_one(w)
        c = pairs.get((v, w), 0)
        return (max(c - two[min(c, 3)], 0) + sum(two[k] * followers[v][k] for k in (1, 2, 3)) * p_one(w)) / uses[v]

    return [(key, h, len(words), sum(plain[w] > 0 for w in words), total,
             sum(math.log10((plain[w] + .1) / (total + .1 * size)) for w in words),
             sum(math.log10(p_two(v, w)) for v, w in zip([("start",), *words], words)))
            for (key, _), words, h in zip(rows, texts, held)]


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def personal(text):
    """Base spans (start, kind number, end) of a text."""
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PERSONAL.items())
                  for m in re.finditer(p, text or "") if _holds(kind, m[0]))


def alignment(text, item):
    """Best local alignment of two texts in words of letters and digits, as a similarity."""
    a, b = (re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower()) for t in (text, item))
    row, best = [0] * (len(a) + 1), 0
    for w in b:
        last, row[0] = 0, 0
        for i, v in enumerate(a, 1):
            cell = max(0, last + (1 if v == w else -1), row[i] - 1, row[i - 1] - 1)
            last, row[i] = row[i], cell
            best = max(best, cell)
    return (1 + best / len(b)) / 2 if b else 0


def shard(key, n, weights):
    """A document's shard by exponential tickets down the tree, then against what was added."""
    def ticket(node, weight):
        seed = 42
        for part in (key, node):
            seed = seed if part is None else xxhash.xxh64_intdigest(part.encode(), seed)
        return -math.log(((seed >> 11) + 0.5) / float(1 << 53)) / weight

    weight = {i: weights.get(i, 1.0) for i in range(n)}
    base = {i: min(w, 1.0) for i, w in weight.items() if i < 24}
    regions = {}
    for i in base:
        regions.setdefault(i % 2, {}).setdefault(i // 2 % 3, []).append(i)
    rack_weight = lambda shards: sum(base[i] for i in shards)
    least, g = min((ticket(f"{g}", sum(map(rack_weight, racks.values()))), g) for g, racks in regions.items())
    _, r = min((ticket(f"{g}/{r}", rack_weight(shards)), r) for r, shards in regions[g].items())
    _, s = min((ticket(f"{g}/{r}/{i}", base[i]), i) for i in regions[g][r])
    added = [(ticket(f"+{i}", w - (1.0 if i < 24 else 0.0)), i) for i, w in weight.items() if i >= 24 or w > 1.0]
    return min([(least, s), *added])[1]


def kneser_ney_of_order(rows, order, others=()):
    """(doc_id, text) -> doc_id, score under the model of ``order`` learned from ``rows``; of ``others`` if given."""
    split = lambda t: WORD.findall(lower(t)) + [None]
    held = lambda key: zlib.crc32(b"" if key is None else str(key).encode()) % 10 == 0
    pad = [("start",)] * (order - 1)
    counts = {k: Counter() for k in range(1, order + 1)}
    for key, t in rows:
        if not held(key):
            words = pad + split(t)
            counts[order].update(tuple(words[i - order + 1:i + 1]) for i in range(order - 1, len(words)))
    for k in range(order - 1, 0, -1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] += 1
    cuts, uses, spare = {}, {}, {}
    for k in counts:
        n = Counter(counts[k].values())
        cuts[k] = [0, .5, 1, 1.5]
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            cuts[k] = [min(max(x, 0), i) for i, x in enumerate([0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]])]
        uses[k], spare[k] = Counter(), Counter()
        for gram, c in counts[k].items():
            uses[k][gram[:-1]] += c
            spare[k][gram[:-1]] += cuts[k][min(c, 3)]
    size = len(counts[1]) + 1

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / size
        context = gram[:-1]
        if not uses[k][context]:
            return p(gram[1:])
        c = counts[k][gram]
        return (max(c - cuts[k][min(c, 3)], 0) + spare[k][context] * p(gram[1:])) / uses[k][context]

    out = []
    for key, t in others or rows:
        words = pad + split(t)
        out.append((key, sum(math.log10(p(tuple(words[i - order + 1:i + 1]))) for i in range(order - 1, len(words)))))
    return out


def language(learned, texts):
    """(text, lang) rows, texts -> (label, score, ambiguous): counts, codewords, bit classifiers and decoding, a text at a time."""
    def grams(text):
        data = bytes(b if 97 <= b < 123 or b >= 128 else 32 for b in f" {text.lower()} ".encode()) if text else b""
        return [((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 % (1 << 32)) >> 16 for i in range(len(data) - 2) if data[i + 1] != 32]

    counts = defaultdict(Counter)
    for text, lang in learned:
        if text is not None and lang is not None:
            counts[lang].update(grams(text))
    labels = sorted(lang for lang in counts if counts[lang])
    if not labels:
        return [("und", 0.0, False) for _ in texts]
    k, size = len(labels), 1 << 16
    code = [[1 if i == 0 or m >> (i - 1) & 1 == 0 else -1 for m in range(1, 1 << (k - 1))] for i in range(k)]
    share = lambda lang, b: (counts[lang][b] + 0.5) / (sum(counts[lang].values()) + 0.5 * size)

    def odds(b, bit):
        sides = [[share(lang, b) for lang, c in zip(labels, code) if c[bit] == side] for side in (1, -1)]
        return math.log(sum(sides[0]) / len(sides[0])) - math.log(sum(sides[1]) / len(sides[1]))

    bits = range(len(code[0]))
    rest = {lang: 0.5 / (sum(counts[lang].values()) + 0.5 * size) for lang in labels}     # buckets that a label never had
    seen = set().union(*(counts[lang] for lang in labels))
    table = {b: [odds(b, bit) for bit in bits] for b in seen}
    never = [odds(-1, bit) for bit in bits]
    margin = [sum(code[i][bit] * (sum(share(lang, b) * table[b][bit] for b in seen) + (size - len(seen)) * rest[lang] * never[bit])
                  for i, lang in enumerate(labels)) / k for bit in bits]
    weight = [max(m, 0.05 * max(margin)) for m in margin] if margin and max(margin) > 0 else [1.0] * len(margin)
    weight = [w / max(sum(weight), 1e-9) for w in weight]
    out = []
    for text in texts:
        if not text or not any(map(str.isalpha, text)):
            out.append(("und", 0.0, False))
            continue
        found = grams(text)
        mean = [sum(table.get(b, never)[bit] for b in found) / len(found) if found else 0.0 for bit in bits]
        loss = [sum(w * np.logaddexp(0, -12.0 * m * c) for w, m, c in zip(weight, mean, row)) for row in code]
        chance = [math.exp(-12.0 * (x - min(loss))) for x in loss]
        chance = [c / sum(chance) for c in chance]
        top = sorted(chance)
        out.append((labels[chance.index(max(chance))], max(chance), k > 1 and top[-1] - top[-2] < 0.02))
    return out

