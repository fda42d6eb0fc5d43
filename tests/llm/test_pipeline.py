"""The pipeline's stages, each on its own input, against brute force where there is one."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tracewright.llm import simhash
from tracewright.llm.common import materialize, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF)))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_language_keeps_clean_documents(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) <= set(before) and len(after) >= 0.97 * sum(any(map(str.isalpha, t or "")) for _, t in before)
    assert all(any(map(str.isalpha, t)) for _, t in after)


def test_exact_keeps_the_largest_id(stages):
    best = {}
    for d, t in rows(stages[1]):
        best[t] = max(d, best.get(t, d))
    assert sorted(rows(stages[2])) == sorted((d, t) for t, d in best.items())


def test_near_keeps_the_smallest_id_of_a_class(stages):
    docs = sorted(rows(stages[2]))
    sets = [set(simhash.shingle_hashes(t, 5)) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert sorted(rows(stages[3])) == [docs[i] for i in range(len(docs)) if find(i) == i]


def test_mixing_changes_numbers_of_copies_only(stages):
    assert set(rows(stages[4])) <= set(rows(stages[3]))


def test_packing_loses_nothing(spark, stages):
    packed = stages[5].collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)
    assert sum(r.start == 0 for r in packed) == stages[4].count()
    assert corpus_pipeline.run(spark, SF).count() == len(packed)


def test_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for stage in (corpus_pipeline.exact, corpus_pipeline.near):
        assert stage(spark, docs, SF).count() > 0 and stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.language(spark, docs, SF).columns == docs.columns
    assert corpus_pipeline.language(spark, docs.limit(0), SF).count() == 0


def test_odd_documents_in_the_later_stages(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.count() > 0 and corpus_pipeline.mix(spark, docs.limit(0), SF).count() == 0
    packed = corpus_pipeline.pack(spark, docs, SF).collect()
    assert sum(r.start == 0 for r in packed) == docs.count() and corpus_pipeline.pack(spark, docs.limit(0), SF).count() == 0


def test_clashing_columns(spark, odd_docs):
    """Names that stages use inside."""
    names = ["__told", "__key", "__row", "__h1", "__h2", "__m", "__tokens", "__p0", "__text", "__hash", "rate", "domain", "kept", "label", "own", "told", "h1", "gone", "least", "c_text"]
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for n in names:
        docs = docs.withColumn(n, F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        for r in out.select(*names).distinct().collect():
            assert tuple(r) == ("x",) * len(names)
