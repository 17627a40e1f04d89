"""Ranked search against scoring every document of every item."""

import math
import random

from vigia.llm import lexical_search as ls
from vigia.llm import queries as q

WORDS = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def brute(docs, items, k):
    import re
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: re.findall(WORDS, (t or "").translate(low))
    bags = [(i, w) for i, t in docs if (w := terms(t))]
    n_docs, n_terms = len(bags), sum(len(w) for _, w in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    df = {t: sum(t in w for _, w in bags) for ts in asked.values() for t in ts}
    out = []
    for item, ts in asked.items():
        scored = []
        for i, w in bags:
            m = 100 - 50 + (50 * len(w) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * f) // (1000 * f + 20 * m))
                    for t in ts if (f := w.count(t)))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def made(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{j}" for j in range(40)] + ["É", "Straße", "x1", "日本"]
    weights = [1 / (j + 1) for j in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40])))) for i in range(n)]
    docs += [(3, docs[3][1]), (None, "w1 w2 w30"), (None, "w1 w2 w30"), (-5, None), (900, ""), (901, " ., "), (902, "W1, w2! " * 3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12])))) for i in range(12)]
    items += [(0, "W39 w38"), (None, "w5 É"), (77, None), (78, "--"), (79, "nowhere")]
    return docs, items


def search(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, ls.search(d, i, **options).collect()), key=str)


def test_against_all_scores(spark):
    docs, items = made(1)
    want = brute(docs, items, 10)
    assert search(spark, docs, items, k=10) == want
    # Small runs and windows, short lists of any length, many blocks of items: the same.
    for options in ({"run_docs": 32, "window": 4, "short_part": 2}, {"run_docs": 64, "window": 8, "short_part": 64},
                    {"run_docs": 16, "window": 16, "short_part": 1, "block_bytes": 40}):
        assert search(spark, docs, items, k=10, **options) == want, options


def test_windows_are_skipped(monkeypatch):
    """A run whose bounds stay below the k-th score is left without reading a list."""
    import numpy as np
    row = {"ids": list(range(64)), "n": [1] * 64, "terms": [0], "df": [64],
           "docs": np.arange(64, dtype=np.int32).tobytes(), "tf": np.ones(64, np.int32).tobytes()}
    run = ls.Run(row, np.array([5]), 64, 64, 8)
    best = ls.Best(2, [(-10 ** 12, False, 1), (-10 ** 12, False, 2)])
    monkeypatch.setattr(best, "add", lambda *a: (_ for _ in ()).throw(AssertionError))
    run.search(np.array([0]), best, 4)


def test_ties_go_by_id(spark):
    docs = [(i, "a b") for i in (9, 4, 7, 1)] + [(None, "a b"), (50, "z")]
    assert search(spark, docs, [(1, "a")], k=3, run_docs=2, window=1) == [(1, 1, 1, s := brute(docs, [(1, "a")], 3)[0][3]), (1, 2, 4, s), (1, 3, 7, s)]


def test_query_edge_cases(spark, tmpdir_path):
    docs, items = made(2, 60)
    d = spark.createDataFrame([(*r, 1, "x", 2.0) for r in docs], "doc_id long, text string, rank int, item_id string, score double")
    i = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, doc_id int")
    d.write.parquet(f"{tmpdir_path}/a/documents.parquet")
    i.write.parquet(f"{tmpdir_path}/a/benchmark.parquet")
    assert sorted(map(tuple, q.op13_lexical_search(spark, f"{tmpdir_path}/a").collect()), key=str) == brute(docs, items, 50)
    for name, (x, y) in {"b": (d.limit(0), i), "c": (d, i.limit(0)), "d": (d.filter("text is null"), i)}.items():
        x.write.parquet(f"{tmpdir_path}/{name}/documents.parquet")
        y.write.parquet(f"{tmpdir_path}/{name}/benchmark.parquet")
        assert q.op13_lexical_search(spark, f"{tmpdir_path}/{name}").collect() == []
