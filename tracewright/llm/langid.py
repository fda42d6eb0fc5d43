"""Language identification by word-first backoff.

A known word scores its log frequency in each language. An unseen word scores by its character n-grams (the word between boundary marks): those
of the longest length of which any is known, the mean of their log frequencies; lengths are tried from MAX_N down to 1. Word scores add up, and
the language with the largest sum wins (of equal sums the one that sorts first).

The model is fitted on a bounded sample: about PER_LANGUAGE labelled rows of each language, chosen by a hash of doc_id; their counts are of whole
texts. Letters are those of str.isalpha. Null and letterless texts are `und` with score 0; words of unknown letters score alike in every language. Rows are independent: repeated
rows get equal results. Without labelled rows every text is `und`; an empty table gives an empty result; further columns stay where `predict`
is asked to keep them.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.common import bound_batches, bounded_sample, materialize, release, small, tidy

PER_LANGUAGE = 4000
WORDS_KEPT = 20_000  # of each language, by count; words of the last count that would pass the number are left out together
MAX_N = 5
LEAST_GRAM = 3  # occurrences of an n-gram that is kept
REMEMBERED = 100_000  # words whose scores a worker remembers
RUNS = re.compile(r"[^\W\d_]+")  # letters, and the numerals that count as word characters without being decimal digits
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters (as str.isalpha has them)."""
    found = RUNS.findall((text or "").lower())
    if not found or "".join(found).isalpha():
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over whole texts, added up in each batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                counts[lang].update(words_of(text))
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])

    bound_batches(docs.sparkSession)
    return docs.select("text", "lang").mapInArrow(tidy(run), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _logs(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(counts))).astype(np.float32)


class Model:
    """Words and n-grams, each with its row in a table of log frequencies by language."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        """counts: (lang, word, n)."""
        self.langs = sorted({lang for lang, _, _ in counts})
        at = {lang: k for k, lang in enumerate(self.langs)}
        self.words: dict[str, int] = {}
        rows = [self.words.setdefault(word, len(self.words)) for _, word, _ in counts]
        table = np.zeros((len(self.words), len(at)))
        np.add.at(table, (rows, [at[lang] for lang, _, _ in counts]), [n for _, _, n in counts])
        self.word_logs = _logs(table)
        self.grams: list[dict[str, int]] = []
        self.gram_logs: list[np.ndarray] = []
        for n in range(1, MAX_N + 1):
            known: dict[str, int] = {}
            pairs = [(known.setdefault(g, len(known)), k) for word, k in self.words.items() for g in grams_of(word, n)]
            sums = np.zeros((len(known), len(at)))
            if pairs:
                place, word = np.array(pairs).T
                for lang in range(len(at)):
                    sums[:, lang] = np.bincount(place, table[word, lang], len(known))
            kept = np.nonzero(sums.sum(axis=1) >= LEAST_GRAM)[0]
            names = list(known)
            self.grams.append({names[k]: i for i, k in enumerate(kept.tolist())})
            self.gram_logs.append(_logs(sums[kept]) if len(kept) else sums[kept])

    def score(self, word: str) -> np.ndarray:
        if (k := self.words.get(word)) is not None:
            return self.word_logs[k]
        for n in range(min(MAX_N, len(word) + 2), 0, -1):
            known = [k for g in grams_of(word, n) if (k := self.grams[n - 1].get(g)) is not None]
            if known:
                return self.gram_logs[n - 1][known].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)


class Predictor:
    """A model with a memory of unseen words; their scores stand below those of the known words in one table."""

    def __init__(self, model: Model):
        self.model = model
        self.known = len(model.words)
        self.table = np.concatenate([model.word_logs, np.zeros((1 << 12, max(1, len(model.langs))), np.float32)]) if model.langs else np.zeros((1, 1), np.float32)
        memory = self

        class Places(dict):
            def __missing__(self, word: str) -> int:
                k = len(self)
                if k == len(memory.table):
                    memory.table = np.concatenate([memory.table, np.zeros((len(memory.table) - memory.known, memory.table.shape[1]), np.float32)])
                memory.table[k] = memory.model.score(word)
                self[word] = k
                return k

        self.places = Places(model.words)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        if len(self.places) > self.known + REMEMBERED:
            self.places.clear()
            self.places.update(self.model.words)
        places = list(map(self.places.__getitem__, words))
        sums = self.table[places].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(sums))
        # evidence of repeated words is worth less than that of as many different ones
        odds = (sums - sums[best]) / math.sqrt(len(words))
        return self.model.langs[best], float(1 / np.exp(odds).sum())


def predictor(held: Broadcast) -> Predictor:
    """One for all tasks of a worker. It hangs on the broadcast model, so it goes with it when the worker turns to other work."""
    model = held.value
    if not hasattr(model, "told"):
        model.told = Predictor(model)
    return model.told


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, words: int = WORDS_KEPT) -> Model:
    """From rows with text and lang (rows without are passed over)."""
    sample = bounded_sample(labelled.filter("text is not null"), "lang", per_language)
    counted = materialize(word_counts(sample))
    sizes: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for r in counted.groupBy("lang", "n").agg(F.count("*").alias("words")).orderBy("lang", F.desc("n")).collect():  # a row for each count that occurs
        sizes[r.lang].append((r.n, r.words))
    limits = []
    for lang, steps in sizes.items():
        total, lowest = 0, steps[0][0]
        for n, more in steps:
            total += more
            if total > words and n != steps[0][0]:
                break
            lowest = n
        limits.append((lang, lowest))
    least = small(labelled.sparkSession.createDataFrame(limits, "lang string, least long"), len(limits))
    top = counted.join(least, "lang").filter("n >= least").orderBy(F.desc("n"), "lang", "word")
    return Model([(r.lang, r.word, r.n) for r in top.collect()])  # bounded by words a language


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score of every row; no shuffle."""
    told = teller(docs.sparkSession, model)
    return docs.select(*keep, told(F.col("text")).alias("__told")).select(*keep, "__told.lang_pred", "__told.score")


def teller(spark: SparkSession, model: Model):
    """A function from a text column to a struct of lang_pred and score."""
    held = spark.sparkContext.broadcast(model)  # bounded by the words kept

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def tell(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = predictor(held)
        for batch in texts:
            found = [own(t) for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["lang_pred", "score"])
        release()

    bound_batches(spark)
    return tell
