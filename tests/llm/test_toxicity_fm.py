"""Toxicity: held-out accuracy, the pair sum written out, pairs that weights miss, edge cases."""

import zlib

import numpy as np

from vigia.llm import toxicity_fm as fm
from vigia.llm.queries import op12_toxicity

LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = op12_toxicity(spark, LARGE).toPandas()
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id").toPandas()
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    both = got[got.held_out].merge(labels, on="doc_id")
    toxic, clean = both[both.toxic == 1], both[both.toxic == 0]
    assert len(toxic) > 100 and toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.01


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) as toxic")
    a, b = fm.fit(docs, labels), fm.fit(docs, flipped)
    assert np.array_equal(a.known, b.known) and np.array_equal(a.vector, b.vector) and a.bias == b.bias


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    known = np.array([2, 5, 9, 11, 30], np.int32)
    m = fm.Machine(0.3, known, rng.normal(size=5), rng.normal(size=(5, 3)))
    rows = [np.array(x, np.int32) for x in ([], [5], [2, 7, 9], [2, 5, 9, 11, 30], [1, 3])]
    for row, margin in zip(rows, m.margins(rows)):
        at = [int(np.searchsorted(known, t)) for t in row if t in known]
        want = 0.3 + sum(m.weight[i] for i in at) + sum(m.vector[i] @ m.vector[j] for i in at for j in at if i < j)
        assert np.isclose(margin, want)


def test_learns_pairs_that_weights_miss():
    """Two insults and two groups, toxic in matching pairs only: no term tells alone."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(2000):
        insult, group = rng.integers(2), rng.integers(2)
        rows.append(np.unique(np.array([10 + insult, 20 + group, *rng.integers(100, 160, 3)], np.int32)))
        y.append(float(insult == group))
    y = np.array(y)
    m = fm.fit_machine(rows[:1500], y[:1500], epochs=60, least_docs=3)
    paired = ((m.score(rows[1500:]) > 0.5) == (y[1500:] > 0.5)).mean()
    m.vector = np.zeros_like(m.vector)
    alone = ((m.score(rows[1500:]) > 0.5) == (y[1500:] > 0.5)).mean()
    assert paired > 0.95 and alone < 0.6


def test_edge_cases(spark, tmpdir_path):
    rows = [(1, None, 5.0), (2, "", 5.0), (3, "word " * 300_000, 5.0), (3, "word " * 300_000, 5.0), (None, "a b", 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmpdir_path}/labels.parquet")
    out = op12_toxicity(spark, tmpdir_path).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    none = fm.fit(docs, labels.limit(0))
    assert all(r["score"] < 1e-3 for r in fm.score(docs, none).collect())
    assert fm.score(docs.limit(0), none).count() == 0
    twice = fm.score(docs, none)
    assert twice.columns == ["doc_id", "text", "score", "predicted"]


def test_terms():
    assert list(fm.terms(None)) == list(fm.terms(b"")) == []
    assert list(fm.terms("ÀB c c".encode())) == list(fm.terms("àb C".encode()))
    assert set(fm.terms(b"word")) < set(fm.terms(b"words word"))
