import hashlib
import random

import numpy as np

from tracewright.llm import phrases as p


def brute_level(symbols):
    """The same parsing, a symbol at a time."""
    folded, k = [], 0
    while k < len(symbols):
        n = 1
        while k + n < len(symbols) and symbols[k + n] == symbols[k]:
            n += 1
        folded.append(symbols[k] if n == 1 else int(p._mix(np.array([(symbols[k] + n * int(p.ODD[2])) % 2**64], np.uint64))[0]))
        k += n
    labels, bits = folded, 64
    for _ in range(p.ROUNDS):
        after = []
        for i, x in enumerate(labels):
            other = labels[i - 1] if i else x ^ ((1 << bits) - 1)
            low = next(b for b in range(64) if (x ^ other) >> b & 1)
            after.append(2 * low + (x >> low & 1))
        labels, bits = after, 8
    begins = [i for i in range(len(labels)) if i == 0 or (0 < i < len(labels) - 1 and labels[i] > labels[i - 1] and labels[i] >= labels[i + 1])]
    names = []
    for a, b in zip(begins, [*begins[1:], len(folded)], strict=True):
        total = sum(x * pow(0xD6E8FEB86659FD93, (j & 255), 1 << 64) for j, x in enumerate(folded[a:b])) % 2**64
        names.append(int(p._mix(np.array([total], np.uint64))[0]))
    return names


def brute_sketch(text):
    symbols, bins = list(map(ord, text)), {}
    for level in range(1, max(p.LEVELS) + 1):
        symbols = brute_level(symbols) if symbols else []
        if level in p.LEVELS and symbols:
            for h in p._mix(np.array(symbols, np.uint64) + np.uint64(level)).tolist():
                bins[h % p.BINS] = min(h, bins.get(h % p.BINS, h))
    return [min(int(p._mix(np.array([bins[b]], np.uint64))[0]) >> 48, p.NONE - 1) if b in bins else p.NONE for b in range(p.BINS)]


def random_text(rng, n):
    return "".join(rng.choice("abcde éñ日  .\n") * rng.choice([1, 1, 1, 1, 5]) for _ in range(n))


def test_sketch_is_brute_force():
    rng = random.Random(2)
    texts = ["", "a", "aa", "aaaa" * 50, "ab" * 300, "\U0001f600x"] + [random_text(rng, rng.randint(1, 300)) for _ in range(60)]
    assert p.sketches(texts).tolist() == [brute_sketch(t) for t in texts]


def test_shared_substrings_share_names():
    rng = random.Random(4)
    body = "".join(rng.choice("abcdefghijklmnop ") for _ in range(6000))
    s = p.sketches([body, "some other head " + body, body[:3000] + body[3100:], "".join(rng.choice("abcdefghijklmnop ") for _ in range(6000))])
    near = p.likeness(np.repeat(s[:1], 4, axis=0), s)
    assert near[0] == 1 and near[1] > 0.85 and near[2] > 0.75 and near[3] < 0.1


def test_edited_is_brute_force(odd_docs):
    rows = sorted(odd_docs.collect(), key=lambda r: (-(r.doc_id if r.doc_id is not None else -(1 << 63)), r.text or ""))
    texts = [r.text or "" for r in rows]
    want = []
    for k, r in enumerate(rows):
        t, following = texts[k], texts[(k + 1) % len(rows)]
        half = len(t) // 2
        new = t[: len(t) - half] + following[:half]
        s = p.sketches([t, new, following])
        near = p.likeness(s[[0, 0]], s[1:])
        want.append((r.doc_id, len(t), hashlib.sha256(new.encode()).hexdigest(), *p.written(s[:2]), float(near[0]), float(near[1])))
    assert sorted(map(tuple, p.compare_edited(odd_docs).collect()), key=str) == sorted(want, key=str)


def test_few_rows(spark, odd_docs, no_docs):
    assert p.compare_edited(no_docs).count() == 0
    one = p.compare_edited(odd_docs.filter("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
