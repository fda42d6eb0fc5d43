import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracewright.llm import simhash as s


def brute_fp(text, width):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(ids, fps, distance):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    arr = np.array(fps, dtype=np.uint64)
    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(arr ^ arr[i]) <= distance)[0]:
            root[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = d if r not in least or (d is not None and (least[r] is None or d < least[r])) else least[r]
    return [least[find(i)] for i in range(len(ids))]


def test_classes_are_brute_force(odd_docs):
    rows = odd_docs.collect()
    fps = [brute_fp(r.text, 4) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], fps, brute_roots([r.doc_id for r in rows], fps, 4), strict=True), key=str)
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in s.classes(odd_docs).collect()), key=str)
    assert got == want


def test_empty(no_docs):
    assert s.classes(no_docs).count() == 0


def planted(n, seed):
    rng = random.Random(seed)
    seeds = [rng.getrandbits(64) for _ in range(n // 8)]
    fps = []
    for k in range(n):
        x = seeds[k % len(seeds)] if k % 3 else seeds[0]
        for b in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << b
        fps.append(x)
    return list(dict.fromkeys(fps))


@pytest.mark.parametrize(("dense", "shared", "distance"), [(1 << 16, 64, 4), (40, 64, 4), (1 << 16, 0, 4), (60, 0, 4), (300, 1, 4), (1 << 16, 64, 3), (1 << 16, 8, 8), (1 << 16, 64, 7)])
def test_links_lose_nothing(spark, monkeypatch, dense, shared, distance):
    monkeypatch.setattr(s, "SHARED", shared)
    monkeypatch.setattr(s, "FOREST", 100)
    fps = planted(900, dense + distance)
    nodes = spark.createDataFrame([(k, x - (1 << 64) if x >> 63 else x) for k, x in enumerate(fps)], "rep long, fp long")
    edges = s.links(nodes, len(fps), distance, dense)
    got = {r.node: r.root for r in s.components(edges).collect()}
    assert [got.get(k, k) for k in range(len(fps))] == brute_roots(list(range(len(fps))), fps, distance)


@pytest.mark.parametrize("per_task", [1 << 20, 50])
def test_components_of_long_chains(spark, monkeypatch, per_task):
    monkeypatch.setattr(s, "EDGES_PER_TASK", per_task)
    n = 400
    edges = [(k, k + 1) for k in range(n) if k % 100 != 99] + [(5, 5), (7, 3)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in s.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: k // 100 * 100 for k in range(n) if k % 100}


def test_dedup_keeps_one_of_each_class(spark, odd_docs):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(400)) for _ in range(12)]
    texts = base + [t.replace(" w1", " x1", 1) for t in base[:6]]
    docs = spark.createDataFrame([(k, t, "fp") for k, t in enumerate(texts)], "doc_id long, text string, fp string")
    out = s.dedup(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == list(range(12))


def test_segments_grow_with_the_table():
    assert [s.segments_for(n, 4) for n in (100, 200_000, 1_000_000, 100_000_000, 10**11)] == [5, 5, 4, 3, 2]


def brute_kept(docs, width=5, least=0.8):
    sets = [set(s.shingle_hashes(t, width)) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 10 * least * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [docs[i] for i in range(len(docs)) if find(i) == i]


def edited(rng, words, edits):
    out = list(words)
    for k in rng.sample(range(len(out)), edits):
        out[k] = f"e{rng.getrandbits(40)}"
    return out


@pytest.mark.parametrize("crowd", [32, 4])
def test_dedup_is_by_likeness(spark, monkeypatch, crowd):
    """Pairs on both sides of the limit, and a crowd of copies of copies whose ends are unlike."""
    monkeypatch.setattr(s, "CROWD", crowd)
    rng = random.Random(4)
    texts = []
    for k in range(60):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(200)]
        texts += [base, edited(rng, base, 2 + k % 9)]  # likenesses of some 0.95 to 0.6
    chain = [f"w{rng.randint(0, 4000)}" for _ in range(200)]
    for _ in range(40):
        texts.append(chain)
        chain = edited(rng, chain, 3)
    rng.shuffle(texts)
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    assert [tuple(r) for r in s.dedup(spark.createDataFrame(docs, "doc_id long, text string")).orderBy("doc_id").collect()] == brute_kept(docs)


def test_ids_join_nothing(spark):
    """Different texts under null and repeated ids, one of which links to a text of another id."""
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(300)) for _ in range(12)]
    docs = [(None, t) for t in base[:5]] + [(7, t) for t in base[5:9]] + [(12, base[0] + " x"), (13, base[1] + " y"), (3, base[5] + " z"), (20, base[9]), (None, base[10]), (None, base[10] + " q")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    fps = [brute_fp(t, 4) for _, t in docs]
    want = sorted(zip([d for d, _ in docs], fps, brute_roots([d for d, _ in docs], fps, 8), strict=True), key=str)
    assert sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in s.classes(df, distance=8).collect()), key=str) == want
    kept = sorted(((r.doc_id, r.text) for r in s.dedup(df).collect()), key=str)
    assert len(kept) == 11 and set(kept) > {docs[k] for k in (2, 3, 4, 6, 7, 8, 9, 10, 11, 12)} and sum(t.startswith(base[10]) for _, t in kept) == 1


@pytest.mark.parametrize("distance", [8, 5])
def test_dense_values_beyond_the_centres(spark, monkeypatch, distance):
    monkeypatch.setattr(s, "SHARED", 0)
    fps = planted(500, distance)
    nodes = spark.createDataFrame([(k, x - (1 << 64) if x >> 63 else x) for k, x in enumerate(fps)], "rep long, fp long")
    got = {r.node: r.root for r in s.components(s.links(nodes, len(fps), distance, 30)).collect()}
    assert [got.get(k, k) for k in range(len(fps))] == brute_roots(list(range(len(fps))), fps, distance)


def test_a_text_is_filed_a_fixed_number_of_times():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 300, 20_000):
        assert s.bands_of(rng.integers(0, 1 << 63, n, dtype=np.uint64)).shape == (s.BANDS,)


def test_blocks_find_pairs_at_the_limit():
    """Share of pairs at a likeness of 0.8 that some band and the full check let through."""
    rng, found = np.random.default_rng(2), 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        y = np.concatenate([x[:178], rng.integers(0, 1 << 63, 22, dtype=np.uint64)])  # 178 of 222
        near = s._near(np.array([s._bits(x)], np.uint64), np.array([s._bits(y)], np.uint64), s.NEAR_SEGMENTS, s.NEAR)[0]
        found += bool(near and (s.bands_of(x) == s.bands_of(y)).any())
    assert found >= 0.97 * 400


def test_chains_of_the_ring_lose_nothing():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 30), replace=False).tolist():
            b[k] ^= np.uint64(1 << bit)
    assert (s._near(a, b, 4, 18) == (np.bitwise_count(a ^ b) <= 18)).all()


@pytest.mark.parametrize("size", [3, 50])
def test_any_two_rows_of_a_key_share_a_part(spark, size):
    rows = s.in_chunks(spark.createDataFrame([(k % 3 if k < 40 else 9, k) for k in range(100)], "key long, rep long"), "key", size).collect()
    parts = {}
    for r in rows:
        parts.setdefault((r.key, r.rep), set()).add(r.part)
    keys = list(parts)
    assert all(parts[a] & parts[b] for a in keys for b in keys if a[0] == b[0])


def linked():
    """A finder of links between rows of a part whose `kind` is equal, which notes how many rows it was sent."""
    sent = []

    def find(rows):
        sent.append(rows.count())
        a, b = rows.select("part", "kind", F.col("rep").alias("a")), rows.select("part", "kind", F.col("rep").alias("b"))
        return a.join(b, ["part", "kind"]).filter("a < b").select("a", "b").distinct()

    return find, sent


@pytest.mark.parametrize("kinds", [1, 2, 3, 40])
@pytest.mark.parametrize("size", [16, 64])
def test_crowds_are_spanned(spark, kinds, size):
    """One crowd of a kind, a few strays that link to one another only, and keys without a largest component."""
    rows = [(1, k, 0 if k % 20 else 1 + k // 20 % kinds) for k in range(400)] + [(2, 1000 + k, k % kinds) for k in range(150)] + [(3, 2000 + k, 7) for k in range(5)]
    df = spark.createDataFrame(rows, "key long, rep long, kind long")
    find, _ = linked()
    got = {r.node: r.root for r in s.components(s.spanning_links(df, "key", find, size)).collect()}
    least = {}
    for key, rep, kind in rows:
        least.setdefault((key, kind), rep)
    assert all(got.get(rep, rep) == least[key, kind] for key, rep, kind in rows)


def test_crowds_cost_rows_in_proportion(spark):
    for n in (500, 2000):
        df = spark.range(n).select(F.lit(1).cast("long").alias("key"), F.col("id").alias("rep"), F.when(F.col("id") < 10, 1).otherwise(0).alias("kind"))
        find, sent = linked()
        s.spanning_links(df, "key", find, 50).count()
        assert sum(sent) < 6 * n
