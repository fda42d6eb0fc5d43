"""Language ID, toxicity and mixing: brute force where there is one, held-out accuracy, and odd tables."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import langid, mixing, toxicity
from tracewright.llm import queries as q
from tracewright.llm.common import table

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


def test_language_backoff():
    counts = [("en", "the", 50), ("en", "thing", 5), ("de", "das", 40), ("de", "schein", 9), ("en", "das", 1)]
    m = langid.Model(counts)
    at = m.langs.index
    total_en, total_de, size = 56, 49, 4
    assert math.isclose(m.score("the")[at("en")], math.log(50.5 / (total_en + 0.5 * size)), rel_tol=1e-5)
    assert math.isclose(m.score("das")[at("de")], math.log(40.5 / (total_de + 0.5 * size)), rel_tol=1e-5)
    unseen = m.score("scheinen")  # known by the five-grams of schein
    known = [k for g in langid.grams_of("scheinen", 5) if (k := m.grams[4].get(g)) is not None]
    assert known and np.allclose(unseen, m.gram_logs[4][known].mean(axis=0)) and unseen[at("de")] > unseen[at("en")]
    assert (m.score("日本") == 0).all()
    tell = langid.Predictor(m)
    assert tell("The thing")[0] == "en" and tell("Das Schein")[0] == "de"
    assert tell(None) == tell("") == tell("123 …") == ("und", 0.0)
    assert 0 < tell("日")[1] <= 1


def test_language_odd_tables(odd_docs, no_docs):
    model = langid.fit(odd_docs)
    rows = langid.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert langid.fit(no_docs).langs == [] and langid.predict(no_docs, model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd_docs, langid.fit(no_docs)).collect()} == {"und"}


@needs_data
def test_language_held_out(spark):
    got = q.op8_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


WORDS = {"idiot": 50, "loser": 50, "the": 500, "stupid": 60, "coat": 40, "boat": 30, "trash": 40, "of": 300, "moron": 30, "pathetic": 30, "clown": 30}


@pytest.mark.parametrize(("told", "meant"), [("1d10t", "idiot"), ("l00ser", "loser"), ("sss7upid", "stupid"), ("s.t.u.p.i.d", "stupid"), ("tr@$h", "trash"), ("m*ron", "moron"), ("looooser", "loser"), ("cl0wn", "clown")])
def test_decoding(told, meant):
    model = toxicity.CharModel(WORDS)
    assert toxicity.decode(told, model) == meant


def test_decoding_is_the_cheapest_path():
    model = toxicity.CharModel(WORDS)
    for token in ("1d10t", "c0at", "b0@t", "st*p"):
        best = None
        paths = [("", 0.0)]
        for ways in toxicity.lattice(token):
            paths = [(t + w, c + paid) for t, c in paths for w, paid in ways]
        for text, paid in paths:
            marked = "^^" + text
            cost = paid + sum(model.cost(marked[k - 2 : k], c) for k, c in enumerate(marked) if k >= 2) + model.cost(marked[-2:], "$")
            best = min(best, (cost, text)) if best else (cost, text)
        assert toxicity.decode(token, model) == best[1]


def test_toxic_terms_are_learned(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgilmnoprstu"), 6)) for _ in range(300)]
    rows = [(k, " ".join(rng.choice(words, 25)) + (" you stup1d" if k % 5 == 0 else " you kind") + " thing", int(k % 5 == 0)) for k in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 4], "doc_id long, toxic int")
    model = toxicity.fit_by_labels(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[k] >= 0.3) == bool(y) for k, _, y in rows)
    clear = spark.createDataFrame([(1, "s t u p i d"), (2, None), (3, ""), (4, "kind")], "doc_id long, text string")
    assert [r.score >= 0.3 for r in toxicity.score(clear, model).orderBy("doc_id").collect()] == [True, False, False, False]


def test_toxicity_counts_every_label(spark):
    """More rows of a label than any fixed sample of 5,000."""
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefgilmnoprstu"))
    rows = [(k, " ".join("".join(rng.choice(letters, 9)) for _ in range(3)) + (" rotten" if k < 5600 else " lovely"), int(k < 5600)) for k in range(6000)]
    docs, labels = (spark.createDataFrame([tuple(r[c] for c in cs) for r in rows], kind) for cs, kind in (((0, 1), "doc_id long, text string"), ((0, 2), "doc_id long, toxic int")))
    assert math.isclose(toxicity.fit_by_labels(docs, labels).terms["rotten"], 5600.5 / 5601, rel_tol=1e-12)


def test_toxicity_fit_by_joins_is_the_same(spark, monkeypatch):
    rng = np.random.default_rng(10)
    words = ["".join(rng.choice(list("abcdefgilmnoprstu"), 6)) for _ in range(60)]
    texts = [" ".join(rng.choice(words, 8)) + (" stupid" if k % 3 == 0 else " kind") for k in range(300)]
    texts += [t + " now" for t in texts[:150]] + texts[:50]  # families of near and exact copies
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int("stupid" in t)) for k, t in enumerate(texts)] + [(7, 1), (7, 0), (None, 1)], "doc_id long, toxic int")
    sent = toxicity.fit_by_labels(docs, labels)
    monkeypatch.setattr(toxicity, "PACKED_ROWS", -1)
    joined = toxicity.fit_by_labels(docs, labels)
    assert sent.terms and (sent.terms, sent.base, sent.chars.counts) == (joined.terms, joined.base, joined.chars.counts)


def test_toxicity_odd_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_by_labels(odd_docs, none)
    assert {r.score for r in toxicity.score(odd_docs, model).collect()} == {0.0}
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit_by_labels(odd_docs, labels)
    assert toxicity.score(odd_docs, model).count() == odd_docs.count() and toxicity.score(no_docs, model).count() == 0


@needs_data
def test_toxicity_held_out(spark):
    got = q.op7_toxicity(spark, SF).join(table(spark, SF, "labels"), "doc_id")
    wrong, clean = got.agg(F.count_if((F.col("toxic") == 0) & (F.col("predicted") == 1)), F.count_if(F.col("toxic") == 0)).first()
    assert wrong <= 0.03 * clean


def brute_rates(tokens, p, targets, pull, rounds):
    n, p = np.array(tokens, float), np.array(p)
    total, wanted = n.sum(), sum(targets)
    ratio = total / wanted
    step, r, y, speed = 1 / (ratio**2 + pull), np.ones(len(n)), np.ones(len(n)), 1.0
    for _ in range(rounds):
        e = ((y * n) @ p - np.array(targets)) / wanted
        new = np.maximum(0, y - step * ratio * (p @ e) - step * pull * (y - 1))
        after = (1 + math.sqrt(1 + 4 * speed**2)) / 2
        y, r, speed = new + (speed - 1) / after * (new - r), new, after
    return r


def test_rates_are_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3] * 3, 200)
    tokens = rng.integers(1, 400, 200)
    rows = spark.createDataFrame([(int(t), *map(float, x)) for t, x in zip(tokens, p, strict=True)], "__tokens long, __p0 double, __p1 double, __p2 double")
    targets = [float(tokens @ p[:, 0]), float(tokens @ p[:, 1]) * 0.3, float(tokens @ p[:, 2]) * 0.05]
    history = mixing.solve(rows, 3, targets, rounds=30)
    got = sorted((r["__tokens"], r.rate) for r in mixing.with_rates(rows, 3, history).collect())
    want = sorted(zip(map(int, tokens), brute_rates(tokens, p, targets, mixing.PULL, 30), strict=True))
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-9)
    long = brute_rates(tokens, p, targets, mixing.PULL, mixing.ROUNDS)
    assert np.allclose((long * tokens) @ p, targets, rtol=0.05, atol=0.01 * sum(targets))


@pytest.mark.parametrize("sharp", [None, 3.0])
def test_every_domain_meets_its_own_target(spark, sharp):
    """A domain of 0.4 % aimed at 2 %, as rates and as copies; hard and soft membership."""
    rng = np.random.default_rng(6)
    n, share = 20_000, [0.886, 0.11, 0.004]
    p = np.eye(3)[rng.choice(3, n, p=share)]
    if sharp:
        p = np.exp(p * sharp + rng.normal(size=p.shape)) * share
        p /= p.sum(axis=1, keepdims=True)
    tokens = rng.integers(1, 400, n)
    rows = spark.createDataFrame([(k, int(t), *map(float, x)) for k, (t, x) in enumerate(zip(tokens, p, strict=True))], "doc_id long, __tokens long, __p0 double, __p1 double, __p2 double")
    targets = [float(tokens @ p[:, 0]) / 0.88 * w for w in (0.88, 0.10, 0.02)]
    rated = mixing.with_rates(rows, 3, mixing.solve(rows, 3, targets, close=mixing.CLOSE)).withColumn("copies", mixing.copies_of(F.col("rate"), "doc_id"))
    for column, near in (("rate", 0.002), ("copies", 0.04)):
        sums = rated.agg(*(F.sum(F.col(column) * F.col("__tokens") * F.col(f"__p{j}")) for j in range(3))).first()
        assert np.allclose(sums, targets, rtol=near, atol=0)


def test_mixing_odd_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert mixing.mix(odd_docs, none).count() == odd_docs.count()
    labels = spark.createDataFrame([(k, "good" if k % 2 else "toxic") for k in range(20)] + [(None, "good"), (3, None)], "doc_id long, domain string")
    out = mixing.mix(odd_docs, labels)
    assert out.columns == odd_docs.columns and out.count() > 0
    assert mixing.rates(no_docs, labels).count() == 0 and mixing.mix(no_docs, labels).count() == 0
