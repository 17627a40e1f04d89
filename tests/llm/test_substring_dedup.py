"""Substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np

from vigia.llm import substring_dedup as sd
from vigia.llm.queries import op6_substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=13):
    low = {}
    words = [WORD.findall(t or "") for _, t in rows]
    last = float("inf")
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            low[key] = min(low.get(key, last), last if i is None else i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if low[tuple(w[k:k + window])] < (last if i is None else i):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["é", "日本 x", "a\x1cb"]
    passage = [[rng.choice(vocab) for _ in range(m)] for m in (12, 13, 14, 40, 90)]
    rows = [(5000, None), (5001, ""), (5002, " \n\t\x0b"), (None, " ".join(passage[3])), (None, " ".join(passage[3]))]
    for i in range(n):
        w = []
        for _ in range(rng.randrange(0, 6)):
            w += rng.choice(passage) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randrange(1, 40))]
        rows.append((i * 7 - 100, rng.choice([" ", "\n", "  \t"]).join(w)))
    rows += [rows[20], rows[20], (rows[21][0], rows[22][1])]
    rows.append((-5000, " ".join(passage[4] * 3)))
    rows.append((9000, "same " * 50_000))
    rows.append((9001, "same " * 12))
    rng.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark, tmpdir_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3) \
        .selectExpr("*", "'x' as part", "1 as n_words").write.parquet(f"{tmpdir_path}/documents.parquet")
    got = sorted(map(tuple, op6_substring_dedup(spark, tmpdir_path).collect()), key=str)
    assert got == brute(rows)


def test_small_flushes_and_general_form(spark):
    rows = corpus(4, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as removed", "'k' as id", "2 as part")
    out = sd.remove_repeats(df.repartition(5), flush=50).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in out),
                 key=str)
    assert got == brute(rows)
    for r in out:
        assert r["n_removed"] == sum(x["end"] - x["start"] for x in r["removed"])
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))
        assert r["id"] == "k" and r["part"] == 2


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"word{k * k % 977}" for k in range(5000)).encode()
    whole = sd.word_hashes([b"x y", text])
    monkeypatch.setattr(sd, "CHUNK", 100)
    pieces = sd.word_hashes([b"x y", text])
    assert np.array_equal(whole[0], pieces[0]) and np.array_equal(whole[1], pieces[1])


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    ids = rng.integers(-(1 << 62), 1 << 62, 1000)
    row = dict(zip(["part", "n", "low", "ids", "first", "gaps"], sd._packed(3, ids, hashes), strict=True))
    back = sd._unpacked(row)
    assert np.array_equal(back[0], ids) and np.array_equal(back[1], hashes)


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
