"""Substring dedup: words covered by a word window that a smaller document has.

Every window of ``window`` consecutive words gets a Rabin-Karp hash (64 bits,
over mixed word hashes).  A task packs the hashes of its documents, sorted and
cut by hash range, into a few binary rows, one smallest document for each
hash, so that a passage that a third of all documents share leaves each task
once.  The packed rows are shuffled by hash range; there every hash gets the
smallest document of all, and the others are told, packed by document shard,
which of their windows repeat.  The documents meet these answers in a second
shuffle, where repeated windows merge into maximal removal intervals.

Two windows count as equal if their hashes are: with n windows the chance of
any false match is about n * n / 2**65 (0.0005 at 130 million windows).

Cases: a null text has no words, a text of fewer words than the window keeps
all; a null doc_id counts as larger than any other; rows of one doc_id do not
remove each other's words; a table without rows gives none; columns that have
the name of a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_list, mix64, record_batch, set_aside, sha256_hex, shards_for, text_slices

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SPACE_AT = re.compile(rb"[\x20\x09-\x0D]")
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id
CHUNK = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of the bytes."""
    word = ~_SPACE[data]
    place = np.flatnonzero(word)
    if not len(place):
        return np.zeros(0, dtype=np.uint64), place
    first = np.flatnonzero(np.append(True, np.diff(place) > 1))
    size = np.diff(np.append(first, len(place)))
    start = place[first]
    offset = place - np.repeat(start, size)
    value = _TABLE[data[place]] * _powers(_BASE, int(size.max()))[offset]
    return mix64(np.add.reduceat(value, first) + size.astype(np.uint64)), start


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the number of words of each.
    Long texts are read in pieces that end between words."""
    joined = b" ".join(t or b"" for t in texts)
    if len(joined) <= 2 * CHUNK:
        h, start = _hash_piece(np.frombuffer(joined, np.uint8))
        ends = np.cumsum([len(t or b"") + 1 for t in texts])
        counts = np.diff(np.append(0, np.searchsorted(start, ends)))
        return h, counts
    if len(texts) > 1:
        parts = [word_hashes([t]) for t in texts]
        return np.concatenate([h for h, _ in parts]), np.concatenate([c for _, c in parts])
    parts, at = [], 0
    while at < len(joined):
        gap = _SPACE_AT.search(joined, min(at + CHUNK, len(joined)))
        end = gap.end() if gap else len(joined)
        parts.append(_hash_piece(np.frombuffer(joined, np.uint8, end - at, at))[0])
        at = end
    h = np.concatenate(parts)
    return h, np.array([len(h)])


def window_hashes(h: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its first word) of every window that lies in one text."""
    if len(h) < window:
        return h[:0], np.zeros(0, dtype=np.int64)
    total = np.append(np.uint64(0), np.cumsum(h * _powers(_BASE_INVERSE, len(h))))
    sums = (total[window:] - total[:-window]) * _powers(_BASE, len(h) - window + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.flatnonzero(text[window - 1:] == text[: len(text) - window + 1])
    return mix64(sums[start]), start


# -- packing ------------------------------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, as many as the largest needs."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: bytes, n: int) -> np.ndarray:
    width = len(data) // n if n else 1
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def _packed(part: int, ids: np.ndarray, hashes: np.ndarray) -> tuple:
    """A row of sorted hashes with the document of each."""
    low = int(ids.min())
    gaps = np.diff(hashes, prepend=hashes[:1])
    return (part, len(ids), low, _planes((ids - low).view(np.uint64)), int(hashes[0:1].view(np.int64)[0]), _planes(gaps))


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    n = row["n"]
    ids = _from_planes(row["ids"], n).view(np.int64) + row["low"]
    first = np.array([row["first"]], dtype=np.int64).view(np.uint64)[0]
    return ids, np.cumsum(_from_planes(row["gaps"], n)) + first


_PACKED = T.StructType([
    T.StructField("answer", T.BooleanType()), T.StructField("part", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("low", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("first", T.LongType()), T.StructField("gaps", T.BinaryType())])


def _rows(answer: bool, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    return record_batch(_PACKED, [[answer] * len(rows), *map(list, columns)])


def _by_range(ids: np.ndarray, hashes: np.ndarray, ranges: int) -> Iterator[tuple]:
    """Sorted hashes cut into equal hash ranges."""
    part = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
        yield _packed(int(part[a]), ids[a:b], hashes[a:b])


def _by_shard(ids: np.ndarray, hashes: np.ndarray, shards: int) -> Iterator[tuple]:
    """Answers for documents, by shard: sorted by hash within each."""
    shard = np.mod(ids, shards)
    order = np.lexsort((hashes, shard))
    ids, hashes, shard = ids[order], hashes[order], shard[order]
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(shard)), strict=True):
        yield _packed(int(shard[a]), ids[a:b], hashes[a:b])


def _smallest(ids: np.ndarray, hashes: np.ndarray):
    """Hashes with their smallest document, and the (document, hash) pairs of
    larger documents."""
    order = np.argsort(hashes, kind="stable")
    ids, hashes = ids[order], hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    low = np.minimum.reduceat(ids, first)
    larger = ids > np.repeat(low, np.diff(np.append(first, len(ids))))
    return low, hashes[first], ids[larger], hashes[larger]


# -- the operator -------------------------------------------------------------

def _scan(window: int, ranges: int, shards: int, flush: int):
    """Batches of (id, text) to packed rows: hashes by range, and at once the
    answers for documents that a smaller one of the same task repeats."""

    def emit(held):
        low, kept, more, again = _smallest(*map(np.concatenate, zip(*held, strict=True)))
        yield _rows(False, list(_by_range(low, kept, ranges)))
        if len(more):
            yield _rows(True, list(_by_shard(more, again, shards)))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in text_slices(batch, "text", CHUNK):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                h, counts = word_hashes(bytes_list(part.column("text")))
                hashes, start = window_hashes(h, counts, window)
                if len(hashes):
                    held.append((np.repeat(ids, counts)[start], hashes))
                    size += len(hashes)
                if size >= flush:
                    yield from emit(held)
                    held, size = [], 0
        if held:
            yield from emit(held)

    return run


def _judge(shards: int):
    """All packed rows of one hash range to answers; answers pass."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("answer")[0].as_py():
            return table
        blocks = [_unpacked(r) for r in table.to_pylist()]
        _, _, more, again = _smallest(*map(np.concatenate, zip(*blocks, strict=True)))
        return pa.Table.from_batches([_rows(True, list(_by_shard(more, again, shards)) if len(more) else [])])

    return run


def _pair_key(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return hashes ^ mix64(ids.view(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def removal_mask(texts: list[bytes | None], ids: np.ndarray, told: np.ndarray, window: int):
    """For each text, a flag for each word: True if a repeated window covers it.
    ``told`` holds the sorted keys of the repeated (document, hash) pairs."""
    h, counts = word_hashes(texts)
    hashes, start = window_hashes(h, counts, window)
    gone = np.zeros(len(h) + 1, dtype=np.int64)
    if len(hashes) and len(told):
        key = _pair_key(np.repeat(ids, counts)[start], hashes)
        hit = start[told[np.minimum(np.searchsorted(told, key), len(told) - 1)] == key]
        gone[hit] += 1  # at most one window starts at a word
        np.add.at(gone, hit + window, -1)
    return np.split(np.cumsum(gone[:-1]) > 0, np.cumsum(counts)[:-1])


def intervals(flags: np.ndarray) -> list[dict]:
    """Maximal runs of True as (start, end), end exclusive."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).tolist()
    return [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _cut(window: int, schema: T.StructType, doc_id: str, text: str, digests: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        blocks = [_unpacked(r) for r in answers.to_pylist()]
        told = (np.unique(np.concatenate([_pair_key(i, h) for i, h in blocks]))
                if blocks else np.zeros(0, dtype=np.uint64))
        hit_ids = np.unique(np.concatenate([i for i, _ in blocks])) if blocks else np.zeros(0, dtype=np.int64)
        out = []
        for batch in docs.combine_chunks().to_batches():
            for part in text_slices(batch, text, CHUNK):
                texts = bytes_list(part.column(text))
                ids = part.column("_id").to_numpy(zero_copy_only=False)
                flagged = np.flatnonzero(np.isin(ids, hit_ids))
                masks = dict(zip(flagged.tolist(), removal_mask([texts[k] for k in flagged], ids[flagged], told, window),
                                 strict=True)) if len(flagged) else {}
                n_words, removed, kept = [], [], []
                for k, t in enumerate(texts):
                    words, mask = (t or b"").split(), masks.get(k)
                    n_words.append(len(words))
                    if mask is not None and mask.any():
                        removed.append(mask)
                        words = [w for w, gone in zip(words, mask.tolist(), strict=True) if not gone]
                    else:
                        removed.append(np.zeros(0, dtype=bool))
                    kept.append(b" ".join(words))
                new = {"n_words": n_words, "n_removed": [int(m.sum()) for m in removed]}
                if digests:
                    new["kept_sha256"] = [sha256_hex(x) for x in kept]
                else:
                    new[text] = [x.decode() for x in kept]
                    new["removed"] = [intervals(m) for m in removed]
                out.append(record_batch(schema, [new[f.name] if f.name in new else part.column(f.name)
                                                 for f in schema.fields]))
        return pa.Table.from_batches(out) if out else pa.Table.from_batches([record_batch(schema, [[] for _ in schema])])

    return run


def remove_repeats(docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text",
                   digests: bool = False, flush: int = 2_000_000) -> DataFrame:
    """The documents with repeated words cut out: ``text`` is the kept words
    joined by one space, ``removed`` the maximal removal intervals (first word,
    end word), next to ``n_words`` and ``n_removed``.  With ``digests`` only the
    id, the two counts and ``kept_sha256``, the digest of the kept text.

    A hash range and a document shard are each held by one task at a time.
    Their numbers follow the bytes of the texts (one shard and two ranges for
    each 64 MB, for each shuffle partition at least), so neither grows with the
    input."""
    docs, names = set_aside(docs, {"_id", "_shard"}, (doc_id, text))
    partitions = shards_for(docs, text)
    shards, ranges = partitions | 1, 2 * partitions
    known = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    counts = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    if digests:
        docs = docs.select(doc_id, text)
        schema = T.StructType([docs.schema[doc_id], *counts, T.StructField("kept_sha256", T.StringType())])
    else:
        spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
        docs = docs.drop("n_words", "n_removed", "removed")
        schema = T.StructType([*docs.schema.fields, *counts, T.StructField("removed", spans)])
    answers = (docs.select(known.alias("id"), F.col(text).alias("text")).mapInArrow(_scan(window, ranges, shards, flush), _PACKED)
               .groupBy("answer", "part").applyInArrow(_judge(shards), _PACKED))
    sharded = docs.withColumn("_id", known).withColumn("_shard", F.pmod("_id", F.lit(shards)).cast("int"))
    return (sharded.groupBy("_shard").cogroup(answers.groupBy("part"))
            .applyInArrow(_cut(window, schema, doc_id, text, digests), schema).withColumnsRenamed(names))
