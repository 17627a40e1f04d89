"""SimHash near-dedup against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from vigia.llm import simhash_variants as sv
from vigia.llm.queries import op10_simhash_near_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, most=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(fps))]


def texts(seed=1, n=250):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["Über", "ÀB", "İ"]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 30, 200]))) for _ in range(n // 3)]
    out = [None, "", " \t\n", "One", "one", "one two", "A B C"] + base
    while len(out) < n:
        words = rng.choice(base).split()
        if words and rng.random() < 0.8:
            words[rng.randrange(len(words))] = rng.choice(vocab)
        out.append(rng.choice([" ", "\n", "  "]).join(words))
    return out


def test_query_equals_brute_force(spark, tmpdir_path):
    rows = list(enumerate(texts()))
    rows += [rows[40], rows[50], (None, "one"), (None, "lonely words here that nobody has")]
    random.Random(2).shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1L as fp", "'x' as root", "2 as component_id") \
        .write.parquet(f"{tmpdir_path}/documents.parquet")
    got = sorted(map(tuple, op10_simhash_near_dedup(spark, tmpdir_path).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components([i for i, _ in rows], fps)
    want = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, comp)), key=str)
    assert got == want
    assert len({c for _, _, c in want}) < len(want) - 50


@pytest.mark.parametrize("large", [2, 40, 16_384])
def test_links_connect_every_close_pair(spark, large):
    """Planted distances around crowded segment values; a small bound sends
    them through the second index."""
    rng = random.Random(7)
    centers = [rng.getrandbits(64) for _ in range(6)]
    fps = set()
    for c in centers:
        for _ in range(120):
            x = c
            for _ in range(rng.randrange(0, 9)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    roots = {r["node"]: r["root"] for r in sv.components(sv.links(df, 3, large=large)).collect()}
    label = [roots.get(int(np.uint64(x).view(np.int64)), int(np.uint64(x).view(np.int64))) for x in fps]
    want = brute_components(list(range(len(fps))), fps)
    pairs = set(zip(label, want, strict=True))
    assert len(pairs) == len(set(label)) == len(set(want))


def test_sweep_of_large_bucket_equals_full_comparison():
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(0, 1 << 12, 900).astype(np.uint64) | (rng.integers(0, 40, 900).astype(np.uint64) << np.uint64(40)))
    zero = np.zeros(len(x), dtype=np.int64)
    u, v = sv.links_within(zero, zero, x, np.array([-1]), 3)
    a, b = np.nonzero(np.triu(sv._close(x, x, 3), 1))
    wu, wv = sv.forest(x[a], x[b])
    assert dict(zip(u.tolist(), v.tolist())) == dict(zip(wu.tolist(), wv.tolist()))


def test_keep_one_keeps_one_row_of_each_component(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts(5, 80))]
    rows += [rows[9], rows[9], (3, "something else entirely with words", "y"), (None, "null id row a b", "z"),
             (None, "null id row a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = sv.keep_one(df).collect()
    assert df.columns == ["doc_id", "text", "fp"]
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    comp = brute_components(list(range(len(rows))), fps)
    of_text = {t: c for (_, t, _), c in zip(rows, comp)}
    assert sorted(of_text[r["text"]] for r in kept) == sorted(set(comp))
    smallest = {}
    for (i, _, _), c in zip(rows, comp):
        if i is not None:
            smallest[c] = min(smallest.get(c, i), i)
    assert all(r["doc_id"] == smallest.get(of_text[r["text"]]) for r in kept)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sv.link_components(df).count() == 0 and sv.keep_one(df).count() == 0
