"""SimHash near-duplicate classes with pigeonring filtering.

Fingerprint: 64 bits; a bit is set if it is set in over half of the XXH64 (seed 42) values of a text's word shingles (repeats count). Two
fingerprints link if at most `distance` bits differ. Classes are the connected components of the links.

Pigeonring: the 64 bits are cut into m segments in a ring. If the total difference is at most t, some segment starts a chain in which each run of
its first l segments differs in at most floor(l * t / m) bits. Every distinct fingerprint is therefore filed under its m segment values, and
looked up under all values within the first budget of them (only bits that are 0 here are flipped where one flip is allowed: of two segments
that differ in one bit, one has the 0). Within a bucket the second and later budgets of the chain prune pairs before the full distance.

Equal fingerprints are folded before anything else, so copies of a text cost one row. Buckets are read as sorted runs; what a
task links is reported as stars to the smallest of each component, never as all pairs. A segment value shared by more than `dense` fingerprints has no
bucket; all that meet it are linked exactly by another way: each is filed under every fingerprint within distance t / 2 of it, and all under one such centre
are within t of each other, so a star to the smallest is made of true links only and no bucket grows with the square of its size.

`dedup` asks for likeness of the sets of shingles (Jaccard), at which some ten of 64 bits differ: too many to file every text under all segment
values near its own. Texts are filed under BANDS values instead, each made of ROWS of their min-hashes, whatever the size of the table; within a
block the ring's chains prune pairs before the full Hamming check at NEAR bits. The components of what passes are read once more with their sets
of shingles, and only texts of exact likeness link. Blocks and components of more than CROWD texts are dealt out as pairs of chunks, so no task
holds more than two chunks and no link is lost.

Null and empty texts have the fingerprint zero and link like any other (the likeness of two texts without words is 1). Repeated rows share their
class; a null doc_id counts as largest. An empty table gives an empty result; further columns are ignored by `classes` and kept by `dedup`.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import bound_batches, boxed, materialize, small, tidy

BITS = 64
SEED = 42
DISTANCE = 4
#: More fingerprints than this under one segment value, and all that meet it are linked through centres instead.
DENSE = 1 << 16
#: The ring has as many segments as leave this many fingerprints under a segment value on average, so the pairs looked at stay in proportion.
SHARED = 64
MOST_CENTRED = 4  # beyond this distance centres would be too many, and dense values are dealt out as pairs of chunks
KEY_BITS = 40  # of a key, for the value; the segment's number stands above
FOREST = 512  # runs longer than this are searched breadth first
EDGES_PER_TASK = 1 << 20
PAIRS = 1 << 19  # pairs of short runs looked at at once
#: `dedup`: texts share a block if ROWS min-hashes agree in one of BANDS bands; at a likeness of 0.8 that misses 1 pair in 200.
BANDS, ROWS = 10, 4
NEAR_SEGMENTS, NEAR = 4, 18  # at a likeness of 0.8, 9.7 of 64 bits differ on average, with a spread of 2.9
LIKENESS = 0.8
CROWD = 2048  # texts of a chunk
CHUNK_SHINGLES = 1 << 21  # and their shingles
_ODD = np.random.default_rng(7).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str, width: int) -> list[int]:
    """XXH64 of each shingle of the text's words (bytes are lower-cased for A-Z only)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = itertools.chain((0,), ends)
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)]


def _bits(values: np.ndarray) -> int:
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(values), 1 << 16):
        counts += np.unpackbits(values[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int) -> int:
    hashes = shingle_hashes(text or "", width)
    return _bits(np.array(hashes, dtype="<u8")) if hashes else 0


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, a hash of the text, and fp (the 64 bits as a signed number) of each row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(found)], names=["doc_id", "text_hash", "fp"])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, text_hash long, fp long")


def ring(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    base, more = divmod(BITS, segments)
    widths = [base + (k < more) for k in range(segments)]
    return [(sum(widths[:k]), w) for k, w in enumerate(widths)]


def _flips(width: int, budget: int) -> list[int]:
    return [sum(1 << b for b in bits) for n in range(1, budget + 1) for bits in itertools.combinations(range(width), n)]


def filed(fps: np.ndarray, segments: int, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For uint64 fingerprints: positions, keys, and whether the key is the fingerprint's own segment value or one near it.

    A key holds the segment's number above its value."""
    budget = distance // segments
    at, keys, near = [], [], []
    every = np.arange(len(fps))
    for k, (shift, width) in enumerate(ring(segments)):
        value = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        top = np.uint64(k << KEY_BITS)
        at.append(every)
        keys.append(value | top)
        near.append(np.zeros(len(fps), bool))
        for mask in _flips(width, budget):
            m = np.uint64(mask)
            some = every[(value & m) == 0] if mask & (mask - 1) == 0 else every
            at.append(some)
            keys.append((value[some] ^ m) | top)
            near.append(np.ones(len(some), bool))
    return np.concatenate(at), np.concatenate(keys).view(np.int64), np.concatenate(near)


def _linked(a: np.ndarray, b: np.ndarray, which: np.ndarray | int, segments: int, distance: int) -> np.ndarray:
    """Which pairs pass the chain that starts at the segment, and then the full check."""
    x = a ^ b
    parts = ring(segments)
    alive = np.ones(len(x), bool)
    for start in range(segments):
        chosen = np.nonzero(which == start)[0] if isinstance(which, np.ndarray) else np.arange(len(x)) if which == start else np.zeros(0, int)
        if not len(chosen):
            continue
        gone = np.zeros(len(chosen), np.int64)
        for n in range(1, segments + 1):
            shift, width = parts[(start + n - 1) % segments]
            gone += np.bitwise_count((x[chosen] >> np.uint64(shift)) & np.uint64((1 << width) - 1))
            fits = gone <= n * distance // segments
            alive[chosen[~fits]] = False
            chosen, gone = chosen[fits], gone[fits]
    return alive


def _near(a: np.ndarray, b: np.ndarray, segments: int, distance: int) -> np.ndarray:
    """Which pairs have a chain of two segments, from any start, within its budgets, and pass the full check."""
    x = a ^ b
    parts = [np.bitwise_count((x >> np.uint64(shift)) & np.uint64((1 << width) - 1)) for shift, width in ring(segments)]
    alive = np.zeros(len(x), bool)
    for k, first in enumerate(parts):
        alive |= (first <= distance // segments) & (first + parts[(k + 1) % segments] <= 2 * distance // segments)
    some = np.nonzero(alive)[0]
    alive[some] = np.bitwise_count(x[some]) <= distance
    return alive


def _forest(fps: np.ndarray, home: np.ndarray, which: int | None, segments: int, distance: int) -> list[tuple[int, int]]:
    """Spanning links of a long run; only pairs with at least one member at home in the bucket count."""
    out = []
    left = np.arange(len(fps))
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            k = todo.pop()
            can = left if home[k] else left[home[left]]
            own = np.full(len(can), fps[k])
            hit = can[_near(own, fps[can], segments, distance) if which is None else _linked(own, fps[can], which, segments, distance)]
            if len(hit):
                out += [(k, int(j)) for j in hit]
                todo += hit.tolist()
                left = left[~np.isin(left, hit, assume_unique=True)]
    return out


def segments_for(n_nodes: int, distance: int) -> int:
    """As many segments as possible, up to one more than the distance, whose values are long enough for so many fingerprints; two at least."""
    return next((m for m in range(distance + 1, 2, -1) if n_nodes <= SHARED << (BITS // m)), 2)


def stars(i: np.ndarray, j: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of linked positions as stars (name, smallest name of the component)."""
    known, place = np.unique(np.concatenate([names[i], names[j]]), return_inverse=True)
    a, b = place[: len(i)], place[len(i) :]
    label = np.arange(len(known))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    some = label != np.arange(len(known))
    return known[some], known[label[some]]


def run_links(keys: np.ndarray, fps: np.ndarray, home: np.ndarray, segments: int, distance: int, filed_by_segment: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs in runs of equal keys (sorted); in long runs as many as span them."""
    edges = np.nonzero(np.diff(keys))[0] + 1
    first, last = np.concatenate(([0], edges)), np.concatenate((edges, [len(keys)]))
    size = last - first
    left, right = [], []
    for a, b in zip(first[size > FOREST], last[size > FOREST], strict=True):
        for i, j in _forest(fps[a:b], home[a:b], int(keys[a]) >> KEY_BITS if filed_by_segment else None, segments, distance):
            left.append(np.array([a + i]))
            right.append(np.array([a + j]))
    short = (size > 1) & (size <= FOREST)
    ends = np.repeat(np.where(short, last, first), size)  # no pairs for the others
    after = np.maximum(ends - np.arange(len(keys)) - 1, 0)
    total = np.cumsum(after)
    begin = 0
    while begin < len(keys) and total[-1] > (total[begin - 1] if begin else 0):
        cut = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIRS, side="right")))
        n = after[begin:cut]
        i = np.repeat(np.arange(begin, min(cut, len(keys))), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        some = home[i] | home[j]
        i, j = i[some], j[some]
        ok = _linked(fps[i], fps[j], keys[i] >> KEY_BITS, segments, distance) if filed_by_segment else _near(fps[i], fps[j], segments, distance)
        left.append(i[ok])
        right.append(j[ok])
        begin = cut
    none = np.zeros(0, int)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def file_nodes(nodes: DataFrame, segments: int, distance: int) -> DataFrame:
    """A row (key, rep, fp, home) for each key under which a node (rep, fp) is filed or looked up; home: the key is its own segment value."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                fps = part.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                at, keys, near = filed(fps, segments, distance)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part.column("rep").to_numpy(zero_copy_only=False)[at]), pa.array(fps[at].view(np.int64)), pa.array(~near)], names=["key", "rep", "fp", "home"])

    return nodes.select("rep", "fp").mapInArrow(tidy(file), "key long, rep long, fp long, home boolean")


def _whole_runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """The columns of sorted rows, cut where the first one, the key, changes."""
    held: list[np.ndarray] | None = None
    for batch in itertools.chain(batches, (None,)):
        columns = None if batch is None else [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if columns is not None and held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        elif columns is None:
            columns = held
        if columns is None or not len(columns[0]):
            continue
        if batch is None:
            whole, held = columns, None
        else:  # the last run may go on in the next batch
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            whole, held = [c[:cut] for c in columns], [c[cut:] for c in columns]
        if len(whole[0]):
            yield whole


def bucket_links(rows: DataFrame, segments: int, distance: int) -> DataFrame:
    """Links (a, b) between filed nodes that share a key."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, reps, fps, home in _whole_runs(batches, ("key", "rep", "fp", "home")):
            i, j = run_links(keys, fps.view(np.uint64), home.astype(bool), segments, distance)
            far, near = stars(i, j, reps)
            yield pa.RecordBatch.from_arrays([pa.array(far), pa.array(near)], names=["a", "b"])

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(tidy(link), "a long, b long")


def crowded(rows: DataFrame, key: str, size: int, shingles: int | None = None) -> DataFrame:
    """Keys of more than `size` rows (or of more than so many shingles, column n), with the number of chunks that they need, `__chunks`."""
    need = F.count("*") / F.lit(size)
    need = F.ceil(F.greatest(need, F.sum("n") / F.lit(shingles)) if shingles else need)
    return materialize(rows.groupBy(key).agg(need.cast("int").alias("__chunks"), F.count("*").alias("__count")).filter("__chunks > 1 AND __count > 1").drop("__count"))


def chunk_of(chunks: str = "__chunks", salt: str = "") -> Column:
    return F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(chunks)).cast("int")


def places(chunks: str = "__chunks") -> Column:
    return F.sequence(F.lit(0), F.coalesce(F.col(chunks), F.lit(1)) - 1)


def pairs_of_chunks(key: str) -> Column:
    """A value for each two chunks of which a row's own is one: any two rows of a key share at least one."""
    return F.transform(places(), lambda j: F.xxhash64(F.col(key), F.least(chunk_of(), j), F.greatest(chunk_of(), j)))


def in_chunks(rows: DataFrame, key: str, size: int, shingles: int | None = None) -> DataFrame:
    """Adds `part`: the key, or for a crowded key a value for each two of its chunks. Rows are dealt to chunks by a hash of rep."""
    parts = F.when(F.col("__chunks").isNull(), F.array(F.col(key))).otherwise(pairs_of_chunks(key))
    return rows.join(small(crowded(rows, key, size, shingles)), key, "left").withColumn("part", F.explode(parts)).drop("__chunks")


def pivoted(many: DataFrame, key: str) -> DataFrame:
    """Adds `part`: each row goes to its own chunk, and about a chunk's worth of rows of each key, the pivots, to all chunks of it."""
    each = F.transform(places(), lambda j: F.xxhash64(F.col(key), j))
    return many.withColumn("part", F.explode(F.when(chunk_of(salt="pivot") == 0, each).otherwise(F.array(F.xxhash64(F.col(key), chunk_of())))))


def left_over(many: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """Adds `part` to rows of keys that are not one component (node, root) yet: any two rows of a key of which one lies outside its largest component share one.

    Rows outside are cut into chunks too; each of these meets every chunk of the key. Where most rows are outside, all pairs of chunks do that in fewer rows."""
    rooted = materialize(many.select(key, "rep").join(small(found), F.col("rep") == F.col("node"), "left").select(key, "rep", F.coalesce("root", "rep").alias("__root")))
    sizes = rooted.groupBy(key, "__root").agg(F.count("*").alias("n")).groupBy(key)
    sizes = sizes.agg(F.max(F.struct("n", "__root")).alias("most"), F.sum("n").alias("all")).filter("most.n < all")
    open_ = materialize(sizes.select(key, F.col("most.__root").alias("__most"), (F.col("all") - F.col("most.n")).alias("__out"), F.col("all").alias("__all")))
    outside = F.col("__root") != F.col("__most")
    # as many as hold a chunk's worth of rows each, by the key's own rate of rows a chunk
    cut = F.ceil(F.col("__out") * F.col("__chunks") / F.col("__all")).cast("int")
    row = many.join(small(open_), key).join(rooted, [key, "rep"]).withColumn("__cut", cut)
    met = F.transform(places("__cut"), lambda i: F.xxhash64(F.col(key), i, chunk_of()))
    sent = F.transform(places(), lambda j: F.xxhash64(F.col(key), chunk_of("__cut", "out"), j))
    few = F.when(outside, F.array_union(met, sent)).otherwise(met)
    parts = F.when(F.col("__out") * 2 > F.col("__all"), pairs_of_chunks(key)).otherwise(few)
    return row.withColumn("part", F.explode(parts)).select(*many.columns, "part")


def spanning_links(rows: DataFrame, key: str, find: Callable[[DataFrame], DataFrame], size: int, shingles: int | None = None) -> DataFrame:
    """Links whose components are those of all links that `find` (rows with part to a, b) sees between two rows (rep) of a key."""
    hot = crowded(rows, key, size, shingles)
    n_hot = hot.count()
    if not n_hot:
        return find(rows.withColumn("part", F.col(key)))
    calm = rows.join(small(hot, n_hot), key, "left_anti").withColumn("part", F.col(key))
    many = rows.join(small(hot, n_hot), key)
    first = materialize(find(calm.unionByName(pivoted(many, key).drop("__chunks"))))
    second = left_over(many, key, materialize(components(first))).drop("__chunks")
    return first.unionByName(find(second))


def part_links(rows: DataFrame, segments: int, distance: int) -> DataFrame:
    """`bucket_links` by part in place of key."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, keys, reps, fps, home in _whole_runs(batches, ("part", "key", "rep", "fp", "home")):
            fps, home = fps.view(np.uint64), home.astype(bool)
            ends = np.append(np.nonzero(np.diff(parts))[0] + 1, len(parts))
            for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
                i, j = run_links(keys[a:b], fps[a:b], home[a:b], segments, distance)
                far, near = stars(i, j, reps[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(far), pa.array(near)], names=["a", "b"])

    return rows.repartition("part").sortWithinPartitions("part", "key").mapInArrow(tidy(link), "a long, b long")


def centre_links(nodes: DataFrame, distance: int) -> DataFrame:
    """Links between nodes that share a fingerprint within distance // 2 of both (all pairs within an even distance do)."""
    masks = np.array([0, *_flips(BITS, distance // 2)], dtype=np.uint64)

    def centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                fps = part.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                all_of = (fps[:, None] ^ masks[None, :]).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(all_of), pa.array(np.repeat(part.column("rep").to_numpy(zero_copy_only=False), len(masks)))], names=["centre", "rep"])

    spread = lambda: nodes.select("rep", "fp").mapInArrow(tidy(centres), "centre long, rep long")
    least = materialize(spread().groupBy("centre").agg(F.min("rep").alias("least"), F.count("*").alias("n")).filter("n > 1").select("centre", "least"))
    return spread().join(least, "centre").filter("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()


def dense_values(nodes: DataFrame, segments: int, dense: int) -> DataFrame:
    """Segment values shared by more than `dense` nodes: at most segments * nodes / dense rows."""
    keys = [F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(k << KEY_BITS).cast("long")) for k, (shift, width) in enumerate(ring(segments))]
    return nodes.select(F.explode(F.array(*keys)).alias("key")).groupBy("key").count().filter(F.col("count") > dense).select("key")


def links(nodes: DataFrame, n_nodes: int, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of nodes (rep, fp) within the distance."""
    segments = segments_for(n_nodes, distance)
    rows = file_nodes(nodes, segments, distance)
    if n_nodes <= dense:  # no value can be shared by more
        return bucket_links(rows, segments, distance)
    heavy = materialize(dense_values(nodes, segments, dense))
    n_heavy = heavy.count()
    if not n_heavy:
        return bucket_links(rows, segments, distance)
    # a link shows under a value that is not dense, or else both of its ends meet a dense one
    met = materialize(rows.join(small(heavy, n_heavy), "key", "left_semi").select("rep").distinct())
    if distance > MOST_CENTRED or distance % 2:
        dealt = in_chunks(rows, "key", dense).select("key", "part", "rep", "fp", "home")
        return part_links(dealt, segments, distance)
    crowd = materialize(nodes.join(small(met), "rep", "left_semi"))
    return bucket_links(rows.join(small(heavy, n_heavy), "key", "left_anti"), segments, distance).unionByName(centre_links(crowd, distance))


def contract(edges: DataFrame, n_edges: int) -> DataFrame:
    """Each task turns the edges that it reads, some EDGES_PER_TASK, into stars (u, v) to the smallest node of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("a").to_numpy(zero_copy_only=False), b.column("b").to_numpy(zero_copy_only=False)) for b in batches]
        if parts:
            a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
            far, near = stars(np.arange(len(a)), np.arange(len(a), 2 * len(a)), np.concatenate([a, b]))
            yield pa.RecordBatch.from_arrays([pa.array(far), pa.array(near)], names=["u", "v"])

    return edges.coalesce(-(-max(1, n_edges) // EDGES_PER_TASK)).mapInArrow(tidy(run), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots; root is the smallest node reachable.

    Tasks contract their own edges first; if one task held them all, that is the answer. Otherwise large and small stars alternate until nothing changes, each round written to the shared folder."""
    edges = materialize(edges.filter("a <> b"))
    n_edges = edges.count()
    now = materialize(contract(edges, n_edges))
    if n_edges > EDGES_PER_TASK:
        now = _star_rounds(materialize(now.distinct()))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _star_rounds(now: DataFrame) -> DataFrame:
    mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = materialize(now.select(F.col("v").alias("u"), F.col("u").alias("far")).join(least, "u").select(F.col("far").alias("u"), F.col("m").alias("v")).distinct())
        parent = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        hooked = large.join(parent, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialize(parent.select("u", F.col("m").alias("v")).unionByName(hooked).distinct())
        then = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now, settled, mark = after, then == mark, then
        if settled:
            break
    return now.groupBy("u").agg(F.min("v").alias("v"))


def classes(docs: DataFrame, width: int = 4, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """doc_id, text_hash, fp, component_id (the smallest doc_id reachable) of every row.

    Nodes are named by their fingerprint: a null or repeated doc_id joins nothing."""
    rows = materialize(fingerprints(docs, width))
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("rep", F.col("fp")))
    found = materialize(components(links(nodes.select("rep", "fp"), nodes.count(), distance, dense)))
    rooted = materialize(nodes.join(small(found), nodes["rep"] == found["node"], "left").select("fp", "least", F.coalesce("root", "rep").alias("root")))
    ids = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")))  # nulls only where all are null
    named = materialize(rooted.join(small(ids), "root").select("fp", "component_id"))
    return rows.join(small(named), "fp").select("doc_id", "text_hash", "fp", "component_id")


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """BANDS values of a set of shingles, each of ROWS of its min-hashes."""
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 1 << 12):
        part = shingles[k : k + (1 << 12)]
        np.minimum(least, ((part ^ (part >> np.uint64(32)))[None, :] * _ODD[:, None]).min(axis=1), out=least)
    least = (least ^ (least >> np.uint64(29))) * _ODD  # the same value in another place of a band is another one
    sums = least.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    return sums ^ (sums >> np.uint64(31))


def block_links(blocks: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that span what lies within the distance in each part of the blocks (part, rep, fp)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, reps, fps in _whole_runs(batches, ("part", "rep", "fp")):
            i, j = run_links(keys, fps.view(np.uint64), np.ones(len(keys), bool), NEAR_SEGMENTS, distance, filed_by_segment=False)
            far, near = stars(i, j, reps)
            yield pa.RecordBatch.from_arrays([pa.array(far), pa.array(near)], names=["a", "b"])

    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(tidy(link), "a long, b long")


def alike(sizes: np.ndarray, shingles: np.ndarray, likeness: float) -> np.ndarray:
    """Class numbers of texts (their sets of shingles in a row, of the sizes given) that span all pairs of at least this Jaccard likeness."""
    m = len(sizes)
    label, done = np.arange(m), np.zeros(m, bool)
    ends = np.cumsum(sizes)
    _, which, often = np.unique(shingles, return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(m), sizes)[np.argsort(which, kind="stable")]  # postings of each shingle
    begins = np.cumsum(often) - often
    while True:
        open_ = np.nonzero(~done & (label != np.argmax(np.bincount(label))))[0]  # pairs within the largest class need no look
        if not len(open_):
            return label
        i = int(open_[0])
        own = which[ends[i] - sizes[i] : ends[i]]
        n = often[own]
        at = np.repeat(begins[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(owners[at], minlength=m)
        hit = shared >= (sizes + sizes[i] - shared) * likeness - 1e-6
        label[np.isin(label, label[hit])] = label[i]
        done[i] = True


def exact_links(sets: DataFrame, likeness: float) -> DataFrame:
    """Links (a, b) that span the pairs of exact likeness in each part of the sets (part, rep, hashes)."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole runs of parts; the last one of a batch may go on in the next."""
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("part").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(keys, keys[-1]))
            if held and not cut and last == keys[0]:
                held.append(batch)
                continue
            if held or cut:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, last = [batch.slice(cut)], keys[-1]
        if held:
            yield pa.Table.from_batches(held)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            parts, reps = (table.column(c).to_numpy() for c in ("part", "rep"))
            lists = pa.concat_arrays(table.column("hashes").chunks)
            offsets, flat = np.asarray(lists.offsets, dtype=np.int64), lists.values.to_numpy()
            first = np.concatenate(([0], np.nonzero(np.diff(parts))[0] + 1, [len(parts)]))
            far, near = [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                if b - a > 1:
                    label = alike(np.diff(offsets[a : b + 1]), flat[offsets[a] : offsets[b]], likeness)
                    some = label != np.arange(b - a)
                    far.append(reps[a:b][some])
                    near.append(reps[a:b][label[some]])
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *far])), pa.array(np.concatenate([none, *near]))], names=["a", "b"])

    return sets.repartition("part").sortWithinPartitions("part").mapInArrow(tidy(link), "a long, b long")


def _labelled(texts: DataFrame, edges: DataFrame) -> DataFrame:
    found = materialize(components(edges))
    return materialize(texts.join(small(found), texts["rep"] == found["node"], "left").select(*texts.columns, F.coalesce("root", "rep").alias("label")))


def near_classes(docs: DataFrame, width: int, distance: int, likeness: float) -> tuple[DataFrame, DataFrame]:
    """The distinct texts (h1, h2, least doc_id, rows, rep, label: the class) and the boxed docs with doc_id, text, h1, h2.

    Texts are named by a number of their own, so that null and repeated doc_ids don't matter."""
    text = F.coalesce("text", F.lit(""))
    keyed = boxed(docs, doc_id=F.col("doc_id").cast("long"), text=text, h1=F.xxhash64(text), h2=F.xxhash64(F.lit("second"), text))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(np.array(shingle_hashes(t, width), dtype="<u8")) for t in batch.column("text").to_pylist()]
            fps = np.array([_bits(x) if len(x) else 0 for x in sets], dtype=np.uint64).view(np.int64)
            bands = np.array([bands_of(x) for x in sets], dtype=np.uint64).reshape(-1).view(np.int64)
            ends = pa.array(np.arange(0, len(bands) + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "h1", "h2")), pa.array([len(x) for x in sets], pa.int64()), pa.array(fps), pa.ListArray.from_arrays(ends, pa.array(bands))], names=["doc_id", "h1", "h2", "n", "fp", "bands"])

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(np.array(shingle_hashes(t, width), dtype=np.uint64)).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "rep", "n")), pa.array(sets, pa.list_(pa.int64()))], names=["key", "rep", "n", "hashes"])

    bound_batches(docs.sparkSession)
    rows = keyed.select("doc_id", "h1", "h2", "text").mapInArrow(tidy(describe), "doc_id long, h1 long, h2 long, n long, fp long, bands array<long>")
    grouped = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"), *(F.first(c).alias(c) for c in ("n", "fp", "bands")))
    texts = materialize(grouped.withColumn("rep", F.monotonically_increasing_id()))  # written once, so the numbers stay
    blocks = texts.select(F.explode("bands").alias("key"), "rep", "fp")
    near = lambda rows: block_links(rows.select("part", "rep", "fp"), distance)
    maybe = _labelled(texts.select("h1", "h2", "rep", "n"), spanning_links(blocks, "key", near, CROWD))
    several = maybe.groupBy("label").agg(F.count("*").alias("texts")).filter("texts > 1").select("label")
    needed = materialize(maybe.join(small(materialize(several)), "label").select("h1", "h2", "rep", "n", F.col("label").alias("key")))
    asked = keyed.select("h1", "h2", "text").join(small(needed), ["h1", "h2"]).select("key", "rep", "n", "text")
    sets = asked.mapInArrow(tidy(shingle), "key long, rep long, n long, hashes array<long>").groupBy("rep").agg(*(F.first(c).alias(c) for c in ("key", "n", "hashes")))
    exact = lambda rows: exact_links(rows.select("part", "rep", "hashes"), likeness)
    return _labelled(texts.select("h1", "h2", "least", "rows", "rep"), spanning_links(materialize(sets), "key", exact, CROWD, CHUNK_SHINGLES)), keyed


def dedup(docs: DataFrame, width: int = 5, distance: int = NEAR, likeness: float = LIKENESS) -> DataFrame:
    """One row of each class of near copies, the one with the smallest doc_id (null ids come last), with all columns."""
    texts, keyed = near_classes(docs, width, distance, likeness)
    classes_of = texts.groupBy("label").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "rep")).alias("keep"), F.sum("rows").alias("all")).filter("all > 1")
    touched = materialize(texts.join(classes_of, "label").select("h1", "h2", "least", (F.col("keep.rep") == F.col("rep")).alias("kept")))
    kept = materialize(touched.filter("kept").select("h1", "h2", "least"))
    others = keyed.join(small(touched.select("h1", "h2")), ["h1", "h2"], "left_anti")
    one = keyed.join(small(kept), ["h1", "h2"]).filter(F.col("doc_id").eqNullSafe(F.col("least"))).dropDuplicates(["h1", "h2"])
    return others.select("own.*").unionByName(one.select("own.*"))


def fingerprint_text(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
