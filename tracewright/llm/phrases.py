"""Document fingerprints by locally consistent parsing.

A text's code points are symbols. At each level equal neighbours fold into one symbol (with their number); then deterministic coin tossing gives
each symbol a small label from the lowest bit in which it differs from its left neighbour, four times over; a phrase begins at each local maximum
of the labels, and its name, a hash of its symbols in order, is a symbol of the next level. Where phrases begin depends on a few neighbours only,
so equal substrings get equal interior names wherever they stand, and an edit changes names near it alone.

The fingerprint keeps the names of levels LEVELS (phrases of some ten code points and more): they are dealt to BINS bins, and of each bin the
smallest name's last 16 bits are written (ffff: no name). The likeness of two fingerprints is the share of equal bins among those that either fills;
of two empty ones it is 1.

Null texts count as empty. Equal texts have equal fingerprints. `successors` orders documents by descending doc_id (nulls last; rows that repeat an
id by text) and puts each beside the next, the first after the last; a single document follows itself. An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import bound_batches, tidy

LEVELS = (2, 3)
BINS = 64
ROUNDS = 4
GROUP = 1 << 18  # code points parsed together (or one longer text)
NONE = 0xFFFF
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
POWERS = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(256)], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[0]
    return (x ^ (x >> np.uint64(29))) * ODD[1]


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels: twice the lowest bit that differs from the left neighbour, plus that bit's value; the first symbol of a text differs from its complement."""
    other = np.empty_like(symbols)
    other[1:] = symbols[:-1]
    other[first] = ~symbols[first]
    differ = symbols ^ other
    lowest = differ & -differ
    place = np.bitwise_count(lowest - symbols.dtype.type(1))
    return (place << 1) | ((symbols & lowest) != 0).view(np.uint8)


def _fold(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal symbols become one; first: where texts begin."""
    begins = np.empty(len(symbols), bool)
    begins[0] = True
    np.not_equal(symbols[1:], symbols[:-1], out=begins[1:])
    begins[first] = True
    if begins.all():
        return symbols, first
    at = np.nonzero(begins)[0]
    size = np.diff(np.append(at, len(symbols)))
    kept = symbols[at]
    many = size > 1
    kept[many] = _mix(kept[many] + size[many].astype(np.uint64) * ODD[2])
    return kept, np.cumsum(begins)[first] - 1


def _level(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases, and where texts begin among them."""
    symbols, first = _fold(symbols, first)
    # folded runs may equal a neighbour only by a collision of hashes; such a pair stays in one phrase
    labels = _toss(symbols, first)
    for _ in range(ROUNDS - 1):
        labels = _toss(labels, first)
    begins = np.zeros(len(labels), bool)
    begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    begins[first[1:] - 1] = False  # a text's last symbol has no right neighbour
    begins[first] = True
    at = np.nonzero(begins)[0]
    place = np.arange(len(symbols)) - np.repeat(at, np.diff(np.append(at, len(symbols))))
    names = _mix(np.add.reduceat(symbols * POWERS[place & 255], at))
    return names, np.cumsum(begins)[first] - 1


def _sketch_group(texts: list[str], out: np.ndarray) -> None:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    full = np.nonzero(lengths)[0]
    if not len(full):
        return
    symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    first = (np.cumsum(lengths) - lengths)[full]
    least = np.full(len(full) * BINS, np.iinfo(np.uint64).max, np.uint64)
    for level in range(1, max(LEVELS) + 1):
        symbols, first = _level(symbols, first)
        if level in LEVELS:
            doc = np.repeat(np.arange(len(full)), np.diff(np.append(first, len(symbols))))
            hashed = _mix(symbols + np.uint64(level))
            np.minimum.at(least, doc * BINS + (hashed % np.uint64(BINS)).astype(np.int64), hashed)
    value = np.minimum(_mix(least) >> np.uint64(48), np.uint64(NONE - 1)).astype(np.uint16)
    value[least == np.iinfo(np.uint64).max] = NONE
    out[full] = value.reshape(-1, BINS)


def sketches(texts: list[str]) -> np.ndarray:
    """(n, BINS) of 16-bit values."""
    out = np.full((len(texts), BINS), NONE, np.uint16)
    begin, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= GROUP:
            _sketch_group(texts[begin : k + 1], out[begin : k + 1])
            begin, held = k + 1, 0
    _sketch_group(texts[begin:], out[begin:])
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    filled = ((a != NONE) | (b != NONE)).sum(axis=1)
    equal = ((a == b) & (a != NONE)).sum(axis=1)
    return np.where(filled, equal / np.maximum(filled, 1), 1.0)


def written(sketch: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in sketch.astype(">u2")]


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(written(sketches([t or "" for t in batch.column("text").to_pylist()])), pa.string())], names=["doc_id", "fingerprint"])

    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, fingerprint string")


def successors(docs: DataFrame) -> DataFrame:
    """Rows (stretch, copy, doc_id, text), sorted so that each row with copy = 0 is followed in its partition by the next document.

    Ids are cut into stretches at quantiles; the first document of a stretch also ends the one before it in descending order, so texts are
    shuffled once and no partition needs another's."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("rank"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    stretches = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(rows.approxQuantile("rank", [k / stretches for k in range(1, stretches)], 1 / (4 * stretches)))) if rows.take(1) else []
    rows = rows.withColumn("stretch", F.size(F.filter(F.array(*map(F.lit, map(int, bounds))).cast("array<bigint>"), lambda b: b <= F.col("rank"))))
    heads = sorted((r.stretch, r.head) for r in rows.groupBy("stretch").agg(F.max("rank").alias("head")).collect())  # a row per stretch
    if not heads:
        return rows.select("stretch", F.lit(0).alias("copy"), "doc_id", "text")
    after = spark.createDataFrame([(head, heads[(k + 1) % len(heads)][0]) for k, (_, head) in enumerate(heads)], "head long, ends int")
    marked = rows.join(F.broadcast(after), rows["rank"] == after["head"], "left")
    one = F.struct(F.col("stretch").alias("to"), F.lit(0).alias("copy"))
    two = F.struct(F.col("ends").alias("to"), F.lit(1).alias("copy"))
    dealt = marked.select("rank", "doc_id", "text", F.explode(F.when(F.col("ends").isNull(), F.array(one)).otherwise(F.array(one, two))).alias("at"))
    dealt = dealt.select(F.col("at.to").alias("stretch"), F.col("at.copy").alias("copy"), "rank", "doc_id", "text")
    # a partition for each stretch, so that no two of them share a task by their hash
    return dealt.repartitionById(stretches, "stretch").sortWithinPartitions("stretch", "copy", F.desc("rank"), "text").select("stretch", "copy", "doc_id", "text")


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text (its second half replaced from the next document), and their likeness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int | None, str]] = []

        def flush(rows: list[tuple[int, int | None, str]]) -> pa.RecordBatch:
            """All rows but the last, which is only looked at as the next one."""
            texts = [r[2] for r in rows]
            pairs = [k for k in range(len(rows) - 1) if rows[k][0] == 0]
            own = sketches(texts)
            changed = [edited(texts[k], texts[k + 1]) for k in pairs]
            other = sketches(changed)
            mine, following = own[pairs], own[[k + 1 for k in pairs]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[k][1] for k in pairs], pa.int64()),
                    pa.array([len(texts[k]) for k in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                    pa.array(written(mine), pa.string()),
                    pa.array(written(other), pa.string()),
                    pa.array(likeness(mine, other), pa.float64()),
                    pa.array(likeness(mine, following), pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            held += zip(*(batch.column(n).to_pylist() for n in ("copy", "doc_id", "text")), strict=True)
            if len(held) > 1:
                yield flush(held)
                held = held[-1:]

    bound_batches(docs.sparkSession)
    return successors(docs).mapInArrow(tidy(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
