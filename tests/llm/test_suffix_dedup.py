"""Suffix-array dedup against brute force over all strings."""

import hashlib
import random

import numpy as np
import pytest

from vigia.llm import suffix_dedup as sd
from vigia.llm.queries import op9_suffix_array_dedup


def brute(rows, least):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for t in data:
        for k in range(len(t) - least + 1):
            seen[t[k:k + least]] = seen.get(t[k:k + least], 0) + 1
    out = []
    for (i, _), t in zip(rows, data, strict=True):
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - least + 1):
            if seen[t[k:k + least]] > 1:
                gone[k:k + least] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, least, n=90):
    rng = random.Random(seed)
    letters = "abcdefghijklmnop éß\n"

    def noise(m):
        return "".join(rng.choice(letters) for _ in range(m))

    passages = [noise(rng.randrange(least // 2, least * 3)) for _ in range(6)]
    exact = noise(least - 1)
    rows = [(None, None), (1, ""), (2, "x" * (least - 1)), (3, "x" * (least + 5)), (4, "ab" * least), (5, noise(least)),
            (6, exact), (7, "q" + exact), (8, exact + "z")]
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randrange(0, 30)
                p = p[a: max(0, len(p) - rng.randrange(0, 30))]
                if p and rng.random() < 0.4:
                    k = rng.randrange(len(p))
                    p = p[:k] + "#" + p[k + 1:]
                parts.append(p)
            else:
                parts.append(noise(rng.randrange(1, 200)))
        rows.append((10 + i, "".join(parts)))
    rows += [rows[20], rows[20], (None, rows[30][1]), (500, rows[40][1] * 2)]
    rng.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark, tmpdir_path):
    rows = corpus(1, 400)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3) \
        .selectExpr("*", "1 as shard", "'d' as digest", "2 as n_bytes").write.parquet(f"{tmpdir_path}/documents.parquet")
    got = op9_suffix_array_dedup(spark, tmpdir_path)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 400)


@pytest.mark.parametrize("crowd", [0, 3, 4096])
def test_crowded_grams_and_short_strings(spark, crowd):
    rows = corpus(2, 60, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "'k' as kind")
    out = sd.remove_repeats(df.repartition(4), least=60, crowd=crowd).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in out]
    assert sorted(got, key=str) == brute(rows, 60)
    assert all(r["kind"] == "k" for r in out)


def test_long_text_in_pieces(spark, monkeypatch):
    rows = corpus(3, 60, 60)
    monkeypatch.setattr(sd, "PIECE", 97)
    found = [sd.anchors((t or "").encode(), 60) for _, t in rows if t and len(t.encode()) >= 60]
    for (_, first, count), (_, t) in zip(found, [r for r in rows if r[1] and len(r[1].encode()) >= 60], strict=True):
        assert count.sum() == len(t.encode()) - 59 and np.array_equal(first, np.append(0, np.cumsum(count)[:-1]))


def test_suffix_array_and_groups_equal_plain_search():
    rng = random.Random(6)
    for _ in range(30):
        texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 60))).encode() for _ in range(5)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        array = sd.SuffixArray(data, sizes, 4)
        joined, ends = b"".join(texts), np.repeat(np.cumsum(sizes), sizes)
        suffix = [joined[i:ends[i]] for i in range(len(joined))]
        for x, y, c in zip(array.order, array.order[1:], array.common, strict=False):
            want = next((k for k, (p, q) in enumerate(zip(suffix[x], suffix[y])) if p != q), min(len(suffix[x]), len(suffix[y])))
            assert c == want
        got = {(length, tuple(sorted(at.tolist()))) for length, at in sd.repeat_groups(array, 4)}
        want = set()
        for s in {suffix[i][:m] for i in range(len(joined)) for m in range(4, len(suffix[i]) + 1)}:
            at = [i for i in range(len(joined)) if suffix[i].startswith(s)]
            left = {-1 - i if i == array.start[i] else joined[i - 1] for i in at}
            right = {suffix[i][len(s)] if len(suffix[i]) > len(s) else -1 - i for i in at}
            if len(at) > 1 and len(left) > 1 and len(right) > 1:
                want.add((len(s), tuple(at)))
        assert got == want


def test_shared_passage_is_one_number_a_shard():
    """A passage that all texts share sends each of its grams once from a shard,
    and the shards are told of it once."""
    import pyarrow as pa

    rng = random.Random(8)
    passage = bytes(rng.randrange(97, 123) for _ in range(90))
    sent = []
    for shard in (0, 1):
        texts = [b"%d " % rng.randrange(10**9) * rng.randrange(1, 4) + passage + b" %d" % (2 * i + shard) for i in range(300)]
        table = pa.table({"digest": [hashlib.sha256(t).digest() for t in texts], "text": texts, "again": [False] * len(texts)})
        gram, _, _, _ = sd._anchors_of(texts, 60)
        rows = sd._count_grams(60, 1)((pa.scalar(shard),), table).to_pylist()
        got = dict(zip(*(x.tolist() for x in sd._columns(rows[0], 2)), strict=True))
        assert len(rows) == 1 and rows[0]["n"] == len(got)
        assert got == dict(zip(*(x.tolist() for x in np.unique(gram, return_counts=True)), strict=True))
        assert max(got.values()) >= 300
        sent += rows
    told = sd._twice(512)((pa.scalar(0),), pa.Table.from_pylist(sent)).to_pylist()
    assert sorted(r["part"] for r in told) == [0, 1]
    for r in told:
        again, crowded = sd._columns(r, 2)
        assert len(set(again.tolist())) == len(again) and crowded.max() == 1


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
