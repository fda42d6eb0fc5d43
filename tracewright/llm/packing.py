"""Packing by power-of-two decomposition.

A document of n tokens (its ids and a closing id 0) is cut into n // max_len pieces of max_len and one piece for each binary digit of the
remainder, longest first. Every piece is a sequence of its own whose length is a power of two, so nothing is padded and no sequence crosses
documents; `bucket` (the length) groups sequences of equal shape into batches. All work is local to a row: no shuffle.

Null and empty texts give the closing id alone. Repeated rows are packed separately, each with sequences of its own. An empty table gives an empty
result. Further columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import bound_batches, tidy

MAX_LEN = 1024
END_ID = 0
#: Token ids of this many distinct words are remembered in a worker, and as many of an older generation.
REMEMBERED = 100_000
#: Texts of these characters, without spaces beside other white space, are cut at spaces: the word rule of byte-level vocabularies has a boundary
#: before each. Other texts, and those with the vocabulary's own special string, go to the tokenizer whole.
OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ɏ]| \s|\s ")
SPECIAL = "<|endoftext|>"
LONG = 32  # words longer than this are not remembered
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level vocabulary, which writes the bytes that aren't printable as letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token != SPECIAL}


class Encoder:
    """Text to little-endian unsigned 32-bit ids, as the tokenizer file has them, with a memory of words.

    Words that are met first are merged by tiktoken under the tokenizer file's own vocabulary; that takes a third of the time of a call of the tokenizer,
    which is loaded only when a text needs it."""

    def __init__(self, path: str):
        import tiktoken

        self.path, self._whole = path, None
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.words = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=byte_ranks(vocabulary), special_tokens={})._core_bpe.encode_ordinary
        encoder = self
        self.older: dict[str, bytes] = {}

        class Known(dict):
            def __missing__(self, word: str) -> bytes:
                found = encoder.older.get(word) or array("I", encoder.words(" " + word)).tobytes()
                if len(word) <= LONG:
                    self[word] = found
                return found

        self.known = Known()

    @property
    def whole(self):
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.path)
        return self._whole

    def __call__(self, text: str) -> bytes:
        if OTHER.search(text) or SPECIAL in text:
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.known) > REMEMBERED:
            self.older = dict(self.known)
            self.known.clear()
        first, *rest = text.split(" ")
        return array("I", self.words(first)).tobytes() + b"".join(map(self.known.__getitem__, rest))


class Vocabulary:
    """A tokenizer file's path, and in a worker its encoder, which all tasks share and which goes with the broadcast when the worker turns to other work."""

    def __init__(self, path: str):
        self.path = path

    def encoder(self) -> Encoder:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if not hasattr(self, "held"):
            self.held = Encoder(self.path)
        return self.held


def pieces_of(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of the pieces of n tokens."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in reversed(range(max_len.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, tokens: bool = True) -> DataFrame:
    """A row per piece: doc_id, start, length, bucket, doc_tokens, sequence_id, offset, ids_crc32, and ids if tokens are asked for.

    sequence_id is the row's place in its partition of the scan (the upper 31 bits are the partition), so it needs no global count and comes out the same when a task runs again."""
    if max_len & (max_len - 1) or max_len < 1:
        raise ValueError("max_len must be a power of two")
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary(tokenizer))  # a path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held.value.encoder()
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            ids: list[int | None] = []
            start, length, count, crc, raw = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = encode(text or "") + end
                n, at = len(own) // 4, 0
                for size in pieces_of(n, max_len):
                    piece = own[4 * at : 4 * (at + size)]
                    ids.append(doc_id)
                    start.append(at)
                    length.append(size)
                    count.append(n)
                    crc.append(zlib.crc32(piece))
                    if tokens:
                        raw.append(np.frombuffer(piece, dtype="<i4"))
                    at += size
            out = [pa.array(ids, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(count, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
            if tokens:
                flat = np.concatenate(raw) if raw else np.zeros(0, np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(length))).astype(np.int32), pa.int32()), pa.array(flat, pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    bound_batches(docs.sparkSession)
    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long" + ", ids array<int>" * tokens
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(tidy(run), schema)
    return packed.withColumns({"bucket": F.col("length"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
