import hashlib
from collections import defaultdict

import numpy as np

from tracewright.llm import exact_dedup as x


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        stays = True
        for i in sorted(ids, key=lambda i: i != keep):
            out.append((i, keep, len(ids), i == keep and stays, hashlib.sha256(text.encode()).hexdigest()))
            stays = False
    return sorted(out, key=str)


def test_assign_is_brute_force(odd_docs):
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in x.assign(odd_docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_empty_table(no_docs):
    assert x.assign(no_docs).count() == 0
    assert x.dedup(no_docs).count() == 0


def test_dedup_keeps_one_row_of_each_text(odd_docs):
    out = x.dedup(odd_docs)
    assert out.columns == odd_docs.columns
    texts = [r.text or "" for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({r.text or "" for r in odd_docs.collect()})


def test_chunks_combine():
    data = np.random.default_rng(1).integers(0, 256, 3 * x.CHUNK + 17).astype(np.uint8)
    one = lambda a: (*map(int, x.fingerprint_bytes(a, np.array([len(a)]))[0]), len(a))
    for cut in (0, 1, x.CHUNK, 5000, len(data)):
        assert x.combine(one(data[:cut]), one(data[cut:])) == one(data)


def test_a_collision_is_found_out(odd_docs, monkeypatch):
    real = x.fingerprints
    from pyspark.sql import functions as F

    monkeypatch.setattr(x, "fingerprints", lambda d: real(d).withColumns({"fp": F.lit(1).cast("long"), "n_bytes": F.lit(1).cast("long")}))
    test_assign_is_brute_force(odd_docs)
