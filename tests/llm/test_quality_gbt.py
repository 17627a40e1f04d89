"""Quality classifier: held-out accuracy, plain walk against flat arrays, edge cases."""

import zlib

import numpy as np
import pytest

from vigia.llm import quality_gbt as qg
from vigia.llm.queries import op1_quality_classifier

MID = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op1_quality_classifier(spark, MID).toPandas()
    docs = spark.read.parquet(f"{MID}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{MID}/labels.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.97
    assert len(both) > 50 and both.quality.min() == 0


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality")
    a, b = qg.fit(docs, labels), qg.fit(docs, flipped)
    assert np.array_equal(a.value, b.value) and np.array_equal(a.threshold, b.threshold)


def test_flat_walk_equals_node_by_node():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(qg.FEATURES)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    f = qg.fit_forest(x, y)
    def walk(row):
        total = f.base
        for n in f.roots:
            while f.feature[n] >= 0:
                n = f.left[n] if row[f.feature[n]] <= f.threshold[n] else f.right[n]
            total += f.value[n]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(f.score(x, rows=37), [walk(r) for r in x])
    assert ((f.score(x) > 0.5) == (y > 0.5)).mean() > 0.95


def test_edge_cases(spark, tmpdir_path):
    rows = [(1, None, 5.0), (2, "", 5.0), (3, "word " * 300_000, 5.0), (3, "word " * 300_000, 5.0), (None, "a b", 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    labels.write.parquet(f"{tmpdir_path}/labels.parquet")
    out = op1_quality_classifier(spark, tmpdir_path).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    none = qg.fit(docs, labels.limit(0))
    assert {r["score"] for r in qg.score(docs, none).collect()} == {0.5}
    assert qg.score(docs.limit(0), none).count() == 0
    assert qg.keep_good(docs, labels.limit(0)).columns == docs.columns


@pytest.mark.parametrize("text,feature,value", [
    (b"a a a b", "adjacent_repeats", 0.5), (b"x\nx\ny", "repeated_lines", 1 / 3), (b"AB", "share_upper", 1.0),
    (b"a b a b", "pair_repeats", 0.5)])
def test_statistics(text, feature, value):
    assert qg.statistics(text)[qg.FEATURES.index(feature)] == pytest.approx(value)
