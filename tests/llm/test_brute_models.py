"""The registered queries of the trained operators against plain second implementations of fit and prediction, on whole tables."""

import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import langid, mixing, toxicity
from tracewright.llm import queries as q
from tracewright.llm.common import table

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def letters(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def test_language_is_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    counts = defaultdict(Counter)
    for d in docs:
        if d.text is not None and d.lang is not None and fold(d.doc_id, 3) != 1:
            counts[d.lang].update(letters(d.text))
    langs = sorted(counts)
    vocabulary = set().union(*counts.values())
    assert max(len(c) for c in counts.values()) <= langid.WORDS_KEPT
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    grams = {n: defaultdict(Counter) for n in range(1, langid.MAX_N + 1)}
    for lang, c in counts.items():
        for word, times in c.items():
            for n in grams:
                marked = f"<{word}>" if n > 1 else word
                for i in range(len(marked) - n + 1):
                    grams[n][marked[i : i + n]][lang] += times
    kept = {n: {g: c for g, c in by.items() if sum(c.values()) >= langid.LEAST_GRAM} for n, by in grams.items()}
    gram_totals = {n: {lang: sum(c[lang] for c in by.values()) for lang in langs} for n, by in kept.items()}

    def score(word):
        if word in vocabulary:
            return [math.log((counts[lang][word] + 0.5) / (totals[lang] + 0.5 * len(vocabulary))) for lang in langs]
        for n in range(langid.MAX_N, 0, -1):
            marked = f"<{word}>" if n > 1 else word
            known = [kept[n][g] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in kept[n]]
            if known:
                return [sum(math.log((c[lang] + 0.5) / (gram_totals[n][lang] + 0.5 * len(kept[n]))) for c in known) / len(known) for lang in langs]
        return [0.0] * len(langs)

    got = {r.doc_id: r for r in q.op8_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        words, r = letters(d.text), got[d.doc_id]
        assert r.held_out == (fold(d.doc_id, 3) == 1)
        if not words:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        sums = [sum(x) for x in zip(*map(score, words), strict=True)]
        best = max(range(len(langs)), key=lambda k: (sums[k], -k))
        want = 1 / sum(math.exp((s - sums[best]) / math.sqrt(len(words))) for s in sums)
        assert math.isclose(r.score, want, rel_tol=2e-3) and (r.lang_pred == langs[best] or r.score < 0.51)


def test_numerals_are_no_letters():
    model = langid.Model([("de", "das", 3), ("en", "the", 3)])
    tell = langid.Predictor(model)
    for text in ("²", "½", "Ⅷ", "٣", "² ½ ³", "1²", "_", "৴"):
        assert tell(text) == ("und", 0.0)
    assert tell("das²") == tell("das ") and langid.words_of("a²b Ⅷx 日本") == ["a", "b", "x", "日本"]


def test_a_rare_language_keeps_its_words(spark):
    rows = [(k, " ".join(f"w{c}x" for c in "abcdefgh"), "en") for k in range(50)] + [(100, "seldom heard words", "xx")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), words=3)
    assert {"seldom", "heard", "words"} <= model.words.keys()


def brute_terms(words):
    return {w for w in words} | {f"{w[:k]}*" for w in words for k in toxicity.PREFIXES if len(w) > k}


def brute_read(text, chars):
    """All terms of a text, without memory or filter."""
    found = set()
    for token in (text or "").split():
        low = token.lower()
        found |= brute_terms(toxicity.WORDS.findall(low))
        inner = low.strip(toxicity.EDGES)
        for form in (inner, low.rstrip(toxicity.EDGES), low.lstrip(toxicity.EDGES)):
            if (not inner.isalpha() or toxicity.REPEATED.search(inner)) and toxicity.disguised(form) and any(map(str.isalpha, form)):
                found |= brute_terms(toxicity.WORDS.findall(toxicity.decode(form, chars)))
    for m in toxicity.SPACED_RUN.finditer(text or ""):
        found |= brute_terms(toxicity.WORDS.findall(toxicity.decode(m[0].replace(" ", "").lower(), chars)))
    return found


def brute_g(a, b, n, m):
    cells = [(a, (a + b) * n / (n + m)), (b, (a + b) * m / (n + m)), (n - a, (n + m - a - b) * n / (n + m)), (m - b, (n + m - a - b) * m / (n + m))]
    return 2 * sum(x * math.log(x / e) for x, e in cells if x) if a * m > b * n else 0.0


def test_toxicity_is_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, LARGER, "documents").collect()}
    labelled = {r.doc_id: r.toxic for r in table(spark, LARGER, "labels").collect() if r.toxic in (0, 1)}
    sample = [(*toxicity.family_keys(docs[d]), docs[d], y) for d, y in labelled.items() if fold(d, 4) != 2 and docs.get(d) is not None]
    for k in range(3):  # of texts with one min-hash in common the first in order stays
        least = {}
        for row in sample:
            key = row[k], row[4]
            order = row[3], *(row[j] for j in range(3) if j != k)
            if key not in least or order < least[key][0]:
                least[key] = order, row
        sample = [row for _, row in least.values()]
    words = Counter(w for row in sample for w in toxicity.WORDS.findall(row[3].lower()))
    top = sorted(words.items(), key=lambda x: (-x[1], x[0].encode()))[: toxicity.LM_WORDS]
    chars = toxicity.CharModel({w: n for w, n in top if len(w) <= 40})
    read = [(brute_read(row[3], chars), row[4]) for row in sample]
    n, m = sum(y for _, y in read), sum(1 - y for _, y in read)
    a, b = Counter(t for found, y in read if y for t in found), Counter(t for found, y in read if not y for t in found)
    likely = sorted((t for t in a if a[t] >= 4 and a[t] >= toxicity.SHARE * (a[t] + b[t])), key=lambda t: (-(a[t] - 2 * b[t]), t.encode()))[: toxicity.CANDIDATES]
    terms = {t: (a[t] + 0.5) / (a[t] + b[t] + 1) for t in likely if brute_g(a[t], b[t], n, m) >= toxicity.SIGNIFICANT}
    rest = Counter(y for found, y in read if not found & terms.keys())
    base = min(0.2, rest[1] / max(1, rest[0] + rest[1]))
    got = {r.doc_id: r for r in q.op7_toxicity(spark, LARGER).collect()}
    assert terms and got.keys() == docs.keys()
    for d, text in docs.items():
        families = defaultdict(float)
        for t in brute_read(text, chars) & terms.keys():
            families[t[:4]] = max(families[t[:4]], terms[t])
        want = 1 - (1 - base) * math.prod(1 - p for p in families.values())
        assert math.isclose(got[d].score, want, rel_tol=1e-9, abs_tol=1e-12) and got[d].predicted == int(want >= 0.3) and got[d].held_out == (fold(d, 4) == 2)


@pytest.mark.parametrize(("size", "share"), [("sf0.01", 0.6), ("sf0.1", 0.85)])
def test_toxic_documents_are_found(spark, size, share):
    """Held-out recall; the smaller table labels some forty toxic documents to learn from."""
    sf = f"/root/testdata/{size}"
    got = q.op7_toxicity(spark, sf).filter("held_out").join(table(spark, sf, "labels"), "doc_id")
    found, toxic, wrong, clean = got.agg(*(F.count_if(c) for c in ((F.col("toxic") == 1) & (F.col("predicted") == 1), F.col("toxic") == 1, (F.col("toxic") == 0) & (F.col("predicted") == 1), F.col("toxic") == 0))).first()
    assert toxic and found >= share * toxic and wrong <= 0.03 * clean


def test_mixing_is_brute_force(spark):
    """The registered query's posteriors by the classifier's formula, its totals against the targets."""
    docs = table(spark, LARGER, "documents").select("doc_id", "text")
    labels = table(spark, LARGER, "labels").select("doc_id", mixing.domain_of().alias("domain"))
    model = mixing.fit(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = q.op6_mixing(spark, LARGER).collect()
    assert len(got) == len(texts) and model.domains == list(mixing.TARGETS)
    tokens = np.array([r.tokens for r in got], float)
    p = np.array([[r[f"p_{d}"] for d in model.domains] for r in got])
    rate, copies = np.array([r.rate for r in got]), np.array([r.copies for r in got])
    assert [len(texts[r.doc_id].split()) for r in got] == [r.tokens for r in got]
    for r, own in zip(got, p, strict=True):
        x = np.array(model.features(texts[r.doc_id])[1])
        z = [sum(w * v for w, v in zip(model.weights[:-1, k], np.clip((x - model.mean) / model.spread, -6, 6), strict=True)) + model.weights[-1, k] for k in range(3)]
        e = [math.exp(v - max(z)) for v in z]
        assert np.allclose(own, [v / sum(e) for v in e], atol=1e-4)
    own = float(tokens @ p[:, 0])
    targets = np.array([own / 0.88 * w for w in mixing.TARGETS.values()])
    assert np.allclose((rate * tokens) @ p, targets, rtol=0.002) and (rate >= 0).all()
    assert (np.abs(copies - rate) < 1).all() and np.allclose((copies * tokens) @ p, targets, rtol=0.1)
    # the optimum is reached: no descent along any document's rate (projected gradient of the weighted squares)
    slope = p @ (((rate * tokens) @ p - targets) / targets)
    assert (np.abs(slope) < 0.01).all()
