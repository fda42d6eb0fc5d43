"""Exact deduplication by composable polynomial fingerprints.

A text's bytes b0 b1 ... have the fingerprint sum(b_i * B^i) mod P for two primes below 2^31, together with the byte length. It is composable:
H(xy) = H(x) + B^|x| H(y), so a huge text is cut into chunks whose hashes are computed side by side and then combined by length-shifted
arithmetic. Rows of equal fingerprint are candidates only: their texts are compared chunk by chunk (smallest and largest chunk at each position of
a group, folded before the shuffle, must agree), and a group that fails is split by its rows' SHA-256.

Nulls count as empty texts; empty texts are equal. Of equal texts the row with the largest doc_id stays, and exactly one of rows that repeat a
doc_id (null ids sort lowest). An empty table gives an empty result; further columns are ignored by the assignment and kept by `dedup`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import bound_batches, boxed, materialize, small, tidy

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)
CHUNK = 4096  # bytes hashed as one unit
BLOCK = 512  # chunks worked on at once
COMPARE = 1 << 15  # code points compared as one unit


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.int64)
    have = 1
    step = base % prime
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step % prime
        have += more
        step = step * step % prime
    return out


POWERS = tuple(_powers(b, p, CHUNK) for b, p in zip(BASES, PRIMES, strict=True))


def _power_of(base: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    out, e, square = np.ones(len(exponents), dtype=np.int64), exponents.astype(np.int64), base % prime
    while e.any():
        out = np.where(e & 1, out * square % prime, out)
        e, square = e >> 1, square * square % prime
    return out


def combine(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """The (hash, hash, length) of x + y from those of x and y."""
    a, b = ((x + pow(base, left[2], p) * y) % p for x, y, base, p in zip(left[:2], right[:2], BASES, PRIMES, strict=True))
    return a, b, left[2] + right[2]


def fingerprint_bytes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints (n, 2) of the consecutive pieces of data that end at the given places."""
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    lengths = ends - starts
    chunks = -(-lengths // CHUNK)
    doc = np.repeat(np.arange(len(ends)), chunks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    at = starts[doc] + nth * CHUNK
    size = np.minimum(CHUNK, ends[doc] - at)
    out = np.zeros((len(ends), 2), dtype=np.int64)
    for k in range(0, len(doc), BLOCK):
        part = slice(k, k + BLOCK)
        first, last = at[k], at[part][-1] + size[part][-1]
        rel = at[part] - first
        place = np.arange(last - first) - np.repeat(rel, size[part])
        piece = data[first:last].astype(np.int64)
        for j, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
            hashes = np.add.reduceat(piece * POWERS[j][place], rel) % prime
            shifted = hashes * _power_of(pow(base, CHUNK, prime), prime, nth[part]) % prime
            np.add.at(out[:, j], doc[part], shifted)
    return out % np.array(PRIMES)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        raw = text.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(raw) else np.zeros(0, np.uint8)
        ends = offsets[1:] - offsets[0]
        h = fingerprint_bytes(data, ends) if len(ends) else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_no"), batch.column("text_sha256"), pa.array((h[:, 0] << 31) | h[:, 1], pa.int64()), pa.array(offsets[1:] - offsets[:-1], pa.int64())], names=["doc_id", "row_no", "text_sha256", "fp", "n_bytes"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, row_no, text_sha256, fp, n_bytes of every row; one pass, no shuffle."""
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("text_sha256")).withColumn("row_no", F.monotonically_increasing_id())
    return rows.mapInArrow(tidy(_fingerprint_batches), "doc_id long, row_no long, text_sha256 string, fp long, n_bytes long")


def assign(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row_no, keep_id, group_size, kept, text_sha256."""
    base = materialize(fingerprints(docs))
    key = ["fp", "n_bytes"]
    groups = materialize(base.groupBy(*key).agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("keep")).filter("group_size > 1"))
    n_groups = groups.count()
    # candidates' texts, cut into units; min = max at each position means that all of the group's texts agree there
    members = materialize(base.join(small(groups.select(*key), n_groups), key, "left_semi").select(F.col("doc_id").alias("member"), *key).distinct())
    units = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .join(small(members), F.col("doc_id").eqNullSafe(F.col("member")))
        .select(*key, F.posexplode(F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / COMPARE).cast("int")), lambda i: F.substring(F.col("text"), i * COMPARE + 1, F.lit(COMPARE)))).alias("nth", "unit"))
    )
    differing = materialize(units.groupBy(*key, "nth").agg(F.min("unit").alias("low"), F.max("unit").alias("high")).filter("low <> high").select(*key).distinct())
    n_differing = differing.count()
    if n_differing:  # a collision: the rows' SHA-256 tell the texts of such a group apart
        tagged = base.join(small(differing.withColumn("split", F.lit(True)), n_differing), key, "left").withColumn("tag", F.when(F.col("split"), F.col("text_sha256")).otherwise("")).drop("split")
        base, key = materialize(tagged), [*key, "tag"]
        groups = materialize(base.groupBy(*key).agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("keep")).filter("group_size > 1"))
        n_groups = groups.count()
    found = base.join(small(groups, n_groups), key, "left")
    return found.select(
        "doc_id",
        "row_no",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keep").isNull() | (F.col("keep.row_no") == F.col("row_no"))).alias("kept"),
        "text_sha256",
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_sha256"))
    found = materialize(assign(docs).select("doc_id", "kept", "text_sha256"))
    dropped = materialize(found.filter(~F.col("kept")).select(row.alias("gone")))
    again = found.filter("kept").select(row.alias("gone")).join(dropped, "gone", "left_semi").distinct()  # a kept row whose id and text another row repeats
    both = materialize(again)
    keyed = boxed(docs, gone=F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))
    lost = materialize(dropped.distinct())
    n, m = lost.count(), both.count()
    out = keyed.join(small(lost, n), "gone", "left_anti")
    if m:
        out = out.unionByName(keyed.join(small(both, m), "gone", "left_semi").dropDuplicates(["gone"]).select(*out.columns))
    return out.select("own.*")
