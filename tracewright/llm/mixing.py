"""Mixing to target weights with soft membership.

A classifier fitted on the labelled table predicts each document's posterior over the domains. Rates r >= 0 are then found for which the
expected tokens of each domain, the sum of r * tokens * posterior, match the targets in the least-squares sense, from r = 1 on: projected gradient
with momentum, whose gradient needs one number a domain, summed over the whole table in each round. Each domain's error is weighted by one over
its share of the tokens, so that small domains settle as fast as large ones; rounds end when every domain is within CLOSE of its own target. A
round only adds column expressions; the rates are written to the shared folder every few rounds, which cuts the lineage.

Documents are then repeated floor(rate + u) times, with u from a hash of the row, so the expected number of copies is the rate. Without a budget of tokens the first domain (the good one) sets it: its tokens keep their
number, and the others are thinned or repeated around it.

Tokens are words between white space. Every text is classified once; what was found is written with the row's own columns. The classifier reads a
bounded sample (PER_DOMAIN labelled rows of each domain). Null and empty texts have no tokens, and rate 1. Repeated rows
get equal posteriors and rates. Without labels, or with one domain only, every rate is 1. An empty table gives an empty result; further columns
are kept by `mix`, those whose names clash with its own included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import bound_batches, bounded_sample, materialize, release, small, tidy, unit_hash

#: Domains of the labelled table in order, the good one first, and their target weights.
TARGETS = {"good": 0.88, "poor": 0.10, "toxic": 0.02}
PER_DOMAIN = 3000
VOCABULARY = 3000  # words that tell domains apart
ROUNDS = 200  # at most
WRITE_EVERY = 12
PULL = 0.0  # towards a rate of 1; any is a bias against the targets
CLOSE = 0.001  # of a domain's own target
CLASSES = tuple(bytes(x) for x in ([*range(97, 123)], [*range(65, 91)], [*range(48, 58)], [*b"#$%&*|<>{}[]~^=+"], [*b".,;:!?"], [*b"\n"]))


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    return F.when(F.col(toxic) == 1, "toxic").when(F.col(quality) == 1, "good").when(F.col(quality) == 0, "poor")


class Classifier:
    """Softmax regression on the shape of a text and on the evidence of its distinct words."""

    def __init__(self, domains: list[str], words: dict[str, int], evidence: np.ndarray):
        self.domains, self.words, self.evidence = domains, words, evidence
        self.known = frozenset(words)
        self.mean = self.spread = self.weights = None

    def features(self, text: str) -> tuple[int, list[float]]:
        raw = text.encode("utf-8", "surrogatepass")
        words = text.lower().split()
        n, size = len(words), max(1, len(raw))
        distinct = set(words)
        shape = [(len(raw) - len(raw.translate(None, c))) / size for c in CLASSES]
        lines = text.split("\n")
        shape += [np.log1p(n), len(distinct) / max(1, n), len(set(lines)) / len(lines), len(raw) / max(1, n) if n else 0.0]
        hit = [self.words[w] for w in {w.strip(".,;:!?") for w in distinct} & self.known]
        told = self.evidence[hit] if hit else np.zeros((1, len(self.domains)))
        return n, [*shape, *told.max(axis=0), *np.tanh(told.sum(axis=0) / 4)]

    def learn(self, x: np.ndarray, y: np.ndarray, rounds: int = 400) -> None:
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([np.clip((x - self.mean) / self.spread, -6, 6), np.ones(len(x))])
        want = np.eye(len(self.domains))[y]
        w = np.zeros((z.shape[1], len(self.domains)))
        step = len(z) / (0.5 * np.linalg.norm(z, 2) ** 2)
        for _ in range(rounds):
            p = np.exp(z @ w - (z @ w).max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            w -= step * (z.T @ (p - want) / len(z) + 1e-3 * w)
        self.weights = w

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.clip((x - self.mean) / self.spread, -6, 6), np.ones(len(x))]) @ self.weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, labels: DataFrame, per_domain: int = PER_DOMAIN) -> Classifier | None:
    """labels: doc_id and domain."""
    chosen = materialize(bounded_sample(labels.filter("doc_id IS NOT NULL AND domain IS NOT NULL").select("doc_id", "domain"), "domain", per_domain))
    sample = materialize(docs.filter("text IS NOT NULL").select("doc_id", "text").join(small(chosen), "doc_id").select("text", "domain"))
    totals = {r.domain: r["count"] for r in sample.groupBy("domain").count().collect()}
    domains = [d for d in TARGETS if d in totals] + sorted(totals.keys() - TARGETS.keys())
    if len(domains) < 2:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Counter((d, w) for t, d in zip(batch.column("text").to_pylist(), batch.column("domain").to_pylist(), strict=True) for w in {w.strip(".,;:!?") for w in t.lower().split()})
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in own], pa.string()), pa.array([k[1] for k in own], pa.string()), pa.array(list(own.values()), pa.int64())], names=["domain", "word", "n"])

    bound_batches(docs.sparkSession)
    counted = sample.mapInArrow(tidy(count), "domain string, word string, n long").groupBy("word").agg(*(F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"n{k}") for k, d in enumerate(domains)))
    total = sum(F.col(f"n{k}") for k in range(len(domains)))
    share = [F.col(f"n{k}") / F.lit(totals[d]) for k, d in enumerate(domains)]
    telling = F.greatest(*(F.sqrt(total.cast("double")) * s for s in share)) * (1 - F.least(*share) / F.greatest(*share))
    top = counted.filter(total >= 5).orderBy(F.desc(telling), "word").limit(VOCABULARY).collect()
    table = np.array([[r[f"n{k}"] for k in range(len(domains))] for r in top], dtype=float).reshape(len(top), len(domains))
    rate = (table + 0.5) / (np.array([totals[d] for d in domains]) + 1)
    evidence = np.log(rate / rate.mean(axis=1, keepdims=True)) if len(top) else np.zeros((1, len(domains)))
    model = Classifier(domains, {r.word: k for k, r in enumerate(top)}, evidence)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.features(t)[1] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("domain")], names=["x", "domain"])

    rows = sample.mapInArrow(tidy(describe), "x array<double>, domain string").collect()  # the bounded sample
    model.learn(np.array([r.x for r in rows]), np.array([domains.index(r.domain) for r in rows]))
    return model


def with_posteriors(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """The rows with __tokens and __p0, __p1, ... in place of __text, written to the shared folder; only the texts go through Python."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by VOCABULARY
    k = len(model.domains) if model else 0

    @F.arrow_udf("struct<tokens: long, p: array<double>>")
    def classify(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        for batch in texts:
            lines = [t or "" for t in batch.to_pylist()]
            if own:
                found = [own.features(t) for t in lines]
                p = own.posteriors(np.array([f[1] for f in found])) if found else np.zeros((0, k))
                tokens = [f[0] for f in found]
            else:
                p, tokens = np.zeros((len(lines), 0)), [len(t.split()) for t in lines]
            ends = pa.array(np.arange(len(lines) + 1, dtype=np.int32) * k)
            yield pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(p.ravel(), pa.float64()))], names=["tokens", "p"])
        release()

    bound_batches(docs.sparkSession)
    told = docs.withColumn("__m", classify(F.col("__text"))).drop("__text")
    return materialize(told.select(*(F.col(c) for c in told.columns if c != "__m"), F.col("__m.tokens").alias("__tokens"), *(F.col("__m.p")[j].alias(f"__p{j}") for j in range(k))))


def solve(members: DataFrame, k: int, targets: list[float], pull: float = PULL, rounds: int = ROUNDS, close: float | None = None) -> list[tuple[float, ...]]:
    """The gradients' history for rows (__tokens, __p0, ...): one (momentum, slope of each domain) a round, from which `rate_of` gives any row's rate.

    With `close`, domains are weighted by one over their share of the tokens, and rounds end when all are that close to their targets."""
    total = float(members.agg(F.sum("__tokens")).first()[0] or 0)
    wanted = sum(targets)
    if not total or not wanted:
        return []
    ratio = total / wanted
    step = 1.0 / (ratio * ratio + pull)
    weights = [1.0] * k
    history: list[tuple[float, ...]] = []
    now = members.withColumns({"__r": F.lit(1.0), "__y": F.lit(1.0)})
    speed = 1.0
    for t in range(rounds):
        sums = now.agg(*(F.sum(F.col("__y") * F.col("__tokens") * F.col(f"__p{j}")).alias(f"s{j}") for j in range(k))).first()
        if close is not None:
            if not t:  # at first every rate is 1
                weights = [total / s if s else 0.0 for s in sums]
            if all(abs(s - g) <= close * (g or wanted) for s, g, w in zip(sums, targets, weights, strict=True) if w):
                history.append((0.0, 0.0, *([0.0] * k)))  # the rates are those just summed
                break
        errors = [w * (s - g) / wanted for s, g, w in zip(sums, targets, weights, strict=True)]
        following = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        entry = ((speed - 1) / following, step * pull, *(step * ratio * e for e in errors))
        speed = following
        history.append(entry)
        now = _step(now, k, entry)
        if (t + 1) % WRITE_EVERY == 0 and t + 1 < rounds:
            now = materialize(now)
    return history


def _step(rows: DataFrame, k: int, entry: tuple[float, ...]) -> DataFrame:
    momentum, pull, *slopes = entry
    slope = sum((F.col(f"__p{j}") * F.lit(slopes[j]) for j in range(k)), F.lit(0.0))
    after = F.greatest(F.lit(0.0), F.col("__y") - slope - F.lit(pull) * (F.col("__y") - 1))
    rows = rows.withColumn("__n", after)
    return rows.withColumn("__y", F.col("__n") + F.lit(momentum) * (F.col("__n") - F.col("__r"))).withColumn("__r", F.col("__n")).drop("__n")


def with_rates(rows: DataFrame, k: int, history: list[tuple[float, ...]]) -> DataFrame:
    """Adds rate: the rounds of the solver replayed on each row, in a vectorised function since a row needs only its own posterior and the history."""
    if not history:
        return rows.withColumn("rate", F.lit(1.0))
    bound_batches(rows.sparkSession)

    @F.arrow_udf("double")
    def replay(*p: pa.Array) -> pa.Array:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in p])
        r = y = np.ones(len(x))
        for momentum, pull, *slopes in history:
            n = np.maximum(0.0, y - x @ np.array(slopes) - pull * (y - 1))
            r, y = n, n + momentum * (n - r)
        return pa.array(r)

    return rows.withColumn("rate", F.when(F.col("__tokens") > 0, replay(*(f"__p{j}" for j in range(k)))).otherwise(1.0))


def _rated(docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float | None) -> tuple[DataFrame, list[str]]:
    """The rows of docs (with a column __text beside their own) with __tokens, posteriors and rate."""
    model = fit(docs.withColumn("text", F.col("__text")), labels)
    members = with_posteriors(docs, model)
    if model is None:
        return members.withColumn("rate", F.lit(1.0)), []
    k = len(model.domains)
    weights = [targets.get(d, 0.0) for d in model.domains]
    if budget is None:
        own = float(members.agg(F.sum(F.col("__tokens") * F.col("__p0"))).first()[0] or 0)
        budget = own / (weights[0] / sum(weights)) if weights[0] else 0.0
    history = solve(members.select("__tokens", *(f"__p{j}" for j in range(k))), k, [budget * w / sum(weights) for w in weights], close=CLOSE)
    return with_rates(members, k, history), model.domains


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, budget: float | None = None) -> DataFrame:
    """doc_id, tokens, posteriors (by domain), rate and copies of every row. labels: doc_id and domain."""
    rated, domains = _rated(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("__hash"), F.col("text").alias("__text")), labels, targets, budget)
    return rated.select("doc_id", F.col("__tokens").alias("tokens"), *(F.col(f"__p{j}").alias(f"p_{d}") for j, d in enumerate(domains)), "rate", copies_of(F.col("rate"), "doc_id", "__hash").alias("copies"))


def copies_of(rate: Column, *key: str) -> Column:
    return F.floor(rate + unit_hash(*(F.col(c) for c in key), salt="mix")).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, budget: float | None = None) -> DataFrame:
    """The rows of docs, each as often as its rate asks for, with their own columns."""
    carried = docs.select(*(F.col(c).alias(f"c_{c}") for c in docs.columns), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("__hash"), F.col("text").alias("__text"))
    rated, _ = _rated(carried, labels, targets, budget)
    n = copies_of(F.col("rate"), "doc_id", "__hash")
    # no filter on the number: it would have the rates worked out once more below it
    return rated.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), n))).select(*(F.col(f"c_{c}").alias(c) for c in docs.columns))
