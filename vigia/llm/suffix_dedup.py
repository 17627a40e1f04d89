"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere.

Strings of ``least`` bytes are found wherever they repeat, in any two places of
the corpus.  A text's strings are dealt to anchors: of all short grams inside a
string, the one of the smallest hash.  Equal strings have equal anchors, so
only anchors whose gram occurs twice can hold a repeat, and of those the bytes
around the anchor (its context) go to the task of the gram's hash range.  There
an enhanced suffix array (prefix doubling, then the common-prefix lengths of
neighbours) of the contexts is scanned with a stack for its common-prefix
intervals; an interval of at least ``least`` bytes whose occurrences differ in
the byte to the left is a maximal repeat group, reported with all occurrences.

Texts are dealt to shards by hash, one copy each: equal texts are collapsed in
the tasks that read them, so copies never gather anywhere, and a text that has
a copy repeats as a whole.  Equal contexts collapse the same way, per shard and
per range.  Which grams occur twice is told by numbers: a shard sends each of its
grams once, with its count, and finds the places of those that it is told of
again in its own texts, so that a gram is one number a shard however many places
it has.  A gram in more than ``crowd`` places (a passage that a great part
of the corpus shares) does not go to a suffix array: its strings are told apart
by their hashes, counted per shard before they are shuffled by hash range, so
that no task holds such a group.

Two anchors or two strings of a crowded gram count as equal if their 64-bit
hashes are; contexts are compared byte by byte.

Cases: a null text counts as empty; texts of fewer than ``least`` bytes keep
all; overlapping strings of one text count, as do copies of a row; doc_id plays
no part (nulls and repeats are fine); a table without rows gives none; columns
that have the name of a result column are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_list, mix64, record_batch, set_aside, sha256_hex, shards_for
from .substring_dedup import _BASE, _BASE_INVERSE, _from_planes, _planes, _powers

_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
GRAM = 32
PIECE = 1 << 19  # strings whose anchors are searched at once


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of every run of ``size`` bytes."""
    n = len(data)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * _power_table(_BASE_INVERSE, n))])
    return mix64((total[size:] - total[:-size]) * _power_table(_BASE, n)[: n - size + 1])


_POWERS: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = _powers(base, max(n, 1 << 16))
    return _POWERS[base][:n]


def anchors(text: bytes, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first string, number of strings) of the anchors of a text.
    Strings are known by the place of their first byte."""
    keys, firsts, counts = [], [], []
    width = least - GRAM + 1
    for a in range(0, len(text) - least + 1, PIECE):
        n = min(PIECE, len(text) - least + 1 - a)  # strings of this piece
        data = np.frombuffer(text, np.uint8, n + least - 1, a)
        h = gram_hashes(data, GRAM)
        # Smallest hash of every window, the rightmost of equal ones: the place
        # counts down in the low bits.  Windows end in two blocks at most.
        low = np.uint64((1 << 20) - 1)
        ranked = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        padded = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max)
        padded[: len(h)] = ranked
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (low - (np.minimum(back[:n], ahead[width - 1: width - 1 + n]) & low)).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        keys.append(mix64(h[place[first]]))  # the smallest hashes, spread over all ranges again
        firsts.append(first + a)
        counts.append(np.diff(np.append(first, n)))
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(counts)


# -- the enhanced suffix array ------------------------------------------------

class SuffixArray:
    """Suffixes of several texts (``data`` with ``sizes``), sorted, and the
    common-prefix length of neighbours.  Prefixes end with their text."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, least: int):
        n = len(data)
        place = np.arange(n)
        self.start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        rest = self.start + np.repeat(sizes, sizes) - place
        padded = np.append(data, np.zeros(8, np.uint8))
        word = np.zeros(n, dtype=np.uint64)
        for j in range(8):
            byte = padded[j: j + n].astype(np.uint64)
            byte[rest <= j] = 0
            word |= byte << np.uint64(56 - 8 * j)
        ended = rest < 8
        order = np.argsort(word)
        group = np.cumsum(np.append(0, word[order[1:]] != word[order[:-1]]))
        order = order[np.argsort(group * 2 + ended[order], kind="stable")]  # ended ones behind their equals
        levels = [(8, _ranks(order, word, ended))]
        size = 8
        while size < sizes.max(initial=0):
            rank = levels[-1][1]
            after = np.zeros(n, dtype=np.int64)
            more = np.flatnonzero(rest > size)
            after[more] = rank[more + size] + 1
            key = rank.astype(np.int64) << 32 | after
            order = np.argsort(key)
            size *= 2
            levels.append((size, _ranks(order, key, rest < size)))
        self.order = order[rest[order] >= least]  # suffixes that can hold a repeat
        a, b = self.order[:-1], self.order[1:]
        common = np.zeros(len(a), dtype=np.int64)
        for size, rank in reversed(levels):
            inside = np.flatnonzero((rest[a] - common >= size) & (rest[b] - common >= size))
            equal = inside[rank[a[inside] + common[inside]] == rank[b[inside] + common[inside]]]
            common[equal] += size
        left = np.minimum(rest[a], rest[b]) - common
        tail = np.flatnonzero(left > 0)
        differ = word[a[tail] + common[tail]] ^ word[b[tail] + common[tail]]
        same = np.zeros(len(tail), dtype=np.int64)
        for j in range(8):  # bytes until the first difference
            same += (same == j) & ((differ >> np.uint64(56 - 8 * j)) & np.uint64(255) == 0)
        common[tail] += np.minimum(same, left[tail])
        self.common = common
        # The byte to the left; at the front of a text a mark of its own.
        self.before = np.where(self.order == self.start[self.order], -1 - self.order, data[self.order - 1].astype(np.int64))


def _ranks(order: np.ndarray, key: np.ndarray, alone: np.ndarray) -> np.ndarray:
    sorted_key, sorted_alone = key[order], alone[order]
    new = np.append(True, (sorted_key[1:] != sorted_key[:-1]) | sorted_alone[1:] | sorted_alone[:-1])
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - 1
    return rank


def repeat_groups(array: SuffixArray, least: int):
    """Maximal repeat groups (length, places): every common-prefix interval of
    at least ``least`` bytes whose occurrences differ in the byte to the left."""
    long = array.common >= least
    edges = np.flatnonzero(np.diff(np.concatenate([[0], long.astype(np.int8), [0]])))
    changes = np.append(0, np.cumsum(array.before[1:] != array.before[:-1]))
    for lo, hi in zip(edges[::2], edges[1::2], strict=True):  # suffixes lo..hi share ``least`` bytes
        if changes[hi] == changes[lo]:
            continue  # every interval in it goes on to the left
        common = array.common[lo:hi].tolist()
        stack: list[tuple[int, int]] = []  # (length, first suffix)
        for i, length in enumerate([*common, least - 1]):
            first = i
            while stack and stack[-1][0] > length:
                held, first = stack.pop()
                if changes[lo + i] != changes[lo + first]:
                    yield held, array.order[lo + first: lo + i + 1]
            if length >= least and (not stack or stack[-1][0] < length):
                stack.append((length, first))


# -- packed rows --------------------------------------------------------------

_GRAMS, _CONTEXTS, _STRINGS, _REPEATS = range(4)
_PACKED = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("columns", T.ArrayType(T.BinaryType()))])
_FOUND = T.StructType([
    T.StructField("digest", T.StringType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())])


def _table(rows: list[tuple]) -> pa.Table:
    columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 5
    return pa.Table.from_batches([record_batch(_PACKED, columns)])


def _pack(kind: int, part: int, shard: int, *columns: np.ndarray, blob: bytes | None = None) -> tuple:
    return (kind, part, shard, len(columns[0]),
            [_planes(c.astype(np.uint64)) for c in columns] + ([blob] if blob is not None else []))


def _columns(row: dict, count: int) -> list[np.ndarray]:
    return [_from_planes(c, row["n"]) for c in row["columns"][:count]]


def _cut_at(part: np.ndarray):
    """(value, from, to) of the runs of a sorted array."""
    if not len(part):
        return iter(())
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    return zip(part[cuts].tolist(), cuts.tolist(), np.append(cuts[1:], len(part)).tolist(), strict=True)


def _repeats(shard: np.ndarray, text: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[tuple]:
    """Rows of repeated stretches, by shard."""
    order = np.lexsort((first, text, shard))
    shard, text, first, size = (x[order] for x in (shard, text, first, size))
    return [_pack(_REPEATS, s, s, text[a:b], first[a:b], size[a:b]) for s, a, b in _cut_at(shard.astype(np.int64))]


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range, one of ``ranges`` equal ones, of each hash."""
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _groups_of(*keys: np.ndarray):
    """(order, first of each group, size of each group) of equal keys."""
    order = np.lexsort(keys)
    new = np.append(True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(order)))


# -- stages -------------------------------------------------------------------

def _collapse(least: int):
    """One row a distinct text of the task, and a row without text for its copies."""

    def run(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            shards, digests, texts, copies = [], [], [], []
            for s, t in zip(batch.column("shard").to_pylist(), bytes_list(batch.column("text")), strict=True):
                digest = hashlib.sha256(t).digest()
                if digest in seen:
                    if seen[digest]:
                        continue
                    seen[digest] = 1  # told once that there are copies
                    texts.append(None)
                else:
                    seen[digest] = 0
                    texts.append(t)
                shards.append(s)
                digests.append(digest)
                copies.append(texts[-1] is None)
            yield record_batch(_SHARDED, [shards, digests, texts, copies])

    return run


_SHARDED = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("digest", T.BinaryType()),
                         T.StructField("text", T.BinaryType()), T.StructField("again", T.BooleanType())])


def _distinct(table: pa.Table) -> tuple[list[bytes], list[bytes], set[bytes]]:
    """Distinct digests of a shard in order, their texts, and those with copies."""
    texts, again = {}, set()
    for digest, t, more in zip(*(table.column(c).to_pylist() for c in ("digest", "text", "again")), strict=True):
        if more or digest in texts:
            again.add(digest)
        if t is not None:
            texts[digest] = t
    digests = sorted(texts)
    return digests, [texts[d] for d in digests], again


def _anchors_of(texts: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    """(gram hash, text, first string, number of strings) of the anchors of a shard."""
    parts = [anchors(t, least) for t in texts]
    gram, first, count = (np.concatenate([p[c] for p in parts]) for c in range(3))
    return gram, np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]), first, count


def _count_grams(least: int, ranges: int):
    """Each gram of a shard's anchors once, with its number of places."""

    def run(key, table):
        shard = key[0].as_py()
        _, texts, _ = _distinct(table)
        if not texts:
            return _table([])
        gram, count = np.unique(_anchors_of(texts, least)[0], return_counts=True)
        return _table([_pack(_GRAMS, p, shard, gram[a:b], count[a:b]) for p, a, b in _cut_at(_range_of(gram, ranges))])

    return run


def _twice(crowd: int):
    """Grams that occur again, told to the shards that have them; crowded ones marked."""

    def run(key, table):
        rows = table.to_pylist()
        gram, count = (np.concatenate(c) for c in zip(*(_columns(r, 2) for r in rows), strict=True))
        shard = np.repeat([r["shard"] for r in rows], [r["n"] for r in rows])
        order, start, size = _groups_of(gram)
        total = np.repeat(np.add.reduceat(count[order].astype(np.int64), start), size)
        order, total = order[total > 1], total[total > 1]
        order_by_shard = np.argsort(shard[order], kind="stable")
        order, crowded = order[order_by_shard], (total[order_by_shard] > crowd).astype(np.int64)
        return _table([_pack(_GRAMS, s, s, gram[order[a:b]], crowded[a:b]) for s, a, b in _cut_at(shard[order])])

    return run


def _contexts(least: int, ranges: int):
    """Contexts of a shard's anchors of repeated grams, equal ones once; hashes
    of the strings of crowded grams."""

    def run(key, docs, told):
        rows = told.to_pylist()
        if not rows:
            return _table([])
        shard = key[0].as_py()
        _, texts, _ = _distinct(docs)
        again, crowded = (np.concatenate(c) for c in zip(*(_columns(r, 2) for r in rows), strict=True))
        order = np.argsort(again)
        again, crowded = again[order], crowded[order]
        gram, text, first, count = _anchors_of(texts, least)
        at = np.minimum(np.searchsorted(again, gram), len(again) - 1)
        told_of = again[at] == gram
        gram, text, first, count, crowded = (x[told_of] for x in (gram, text, first, count, crowded[at]))
        out = []
        usual = np.flatnonzero(crowded == 0)
        usual = usual[np.argsort(gram[usual], kind="stable")]
        kept, known, done = [], {}, []
        for k in usual.tolist():
            context = texts[text[k]][first[k]: first[k] + count[k] - 1 + least]
            mine = (int(gram[k]), context)
            if mine in known:
                done.append(k)
                known[mine][1] = True
            else:
                known[mine] = [k, False]
                kept.append((k, context, known[mine]))
        done += [k for k, _, info in kept if info[1]]
        if kept:
            ks = np.array([k for k, _, _ in kept])
            flags = np.array([info[1] for _, _, info in kept], dtype=np.int64)
            for p, a, b in _cut_at(_range_of(gram[ks], ranges)):
                part = ks[a:b]
                out.append(_pack(_CONTEXTS, p, shard, gram[part], text[part], first[part], count[part], flags[a:b],
                                 blob=b"".join(c for _, c, _ in kept[a:b])))
        strings, of_text, at = [], [], []
        for k in np.flatnonzero(crowded == 1).tolist():
            h = gram_hashes(np.frombuffer(texts[text[k]], np.uint8, count[k] - 1 + least, first[k]), least)
            strings.append(h)
            of_text.append(np.full(len(h), text[k]))
            at.append(first[k] + np.arange(len(h)))
        found = [(np.full(len(done), shard), text[done], first[done], count[done] - 1 + least)] if done else []
        if strings:
            h, of_text, at = map(np.concatenate, (strings, of_text, at))
            order, start, size = _groups_of(h)
            again = order[np.repeat(size, size) > 1]
            found.append((np.full(len(again), shard), of_text[again], at[again], np.full(len(again), least)))
            one = order[start]
            for p, a, b in _cut_at(_range_of(h[one], ranges)):
                out.append(_pack(_STRINGS, p, shard, h[one[a:b]], of_text[one[a:b]], at[one[a:b]]))
        if found:
            out += _repeats(*map(np.concatenate, zip(*found, strict=True)))
        return _table(out)

    return run


def _resolve(least: int, batch_bytes: int = 1 << 18):
    """Repeated stretches of a gram range's contexts, or of a hash range's strings."""

    def run(key, table):
        kind = key[0].as_py()
        if kind == _REPEATS:
            return table
        rows = table.to_pylist()
        shard = np.repeat([r["shard"] for r in rows], [r["n"] for r in rows])
        if kind == _STRINGS:
            h, text, first = (np.concatenate(c) for c in zip(*(_columns(r, 3) for r in rows), strict=True))
            order, _, size = _groups_of(h)
            again = order[np.repeat(size, size) > 1]
            return _table(_repeats(shard[again], text[again], first[again], np.full(len(again), least)))
        gram, text, first, count, flag = (np.concatenate(c) for c in zip(*(_columns(r, 5) for r in rows), strict=True))
        size = count.astype(np.int64) - 1 + least
        places = [b"".join(r["columns"][5:6]) for r in rows]
        contexts, k = [], 0
        for r, blob in zip(rows, places, strict=True):
            ends = np.cumsum(size[k: k + r["n"]]).tolist()
            contexts += [blob[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            k += r["n"]
        found = []
        # Equal contexts of the same gram repeat as a whole; one of them stays.
        by_gram: dict[int, dict[bytes, list[int]]] = {}
        for k, g in enumerate(gram.tolist()):
            by_gram.setdefault(g, {}).setdefault(contexts[k], []).append(k)
        whole: list[int] = []
        batch: list[int] = []
        held = 0

        def flush():
            sizes = size[batch]
            data = np.frombuffer(b"".join(contexts[k] for k in batch), np.uint8)
            array = SuffixArray(data, sizes, least)
            owner = np.repeat(np.arange(len(batch)), sizes)
            reach = np.zeros(len(data), dtype=np.int64)
            for length, at in repeat_groups(array, least):
                reach[at] = np.maximum(reach[at], length)
            at = np.flatnonzero(reach)
            mine = np.array(batch)[owner[at]]
            open_ = flag[mine] == 0
            at, mine = at[open_], mine[open_]
            if len(at):
                found.append((shard[mine], text[mine].astype(np.int64),
                              first[mine].astype(np.int64) + at - array.start[at], reach[at]))

        for members in by_gram.values():
            for ks in members.values():
                if len(ks) > 1:
                    whole += [k for k in ks if not flag[k]]
                    flag[ks] = 1
            if len(members) < 2 or all(flag[ks[0]] for ks in members.values()):
                continue
            batch += [ks[0] for ks in members.values()]
            held += sum(len(c) for c in members)
            if held >= batch_bytes:
                flush()
                batch, held = [], 0
        if batch:
            flush()
        if whole:
            found.append((shard[whole], text[whole].astype(np.int64), first[whole].astype(np.int64), size[whole]))
        return _table(_repeats(*map(np.concatenate, zip(*found, strict=True))) if found else [])

    return run


def _remove(least: int, with_bytes: bool):
    """Of each text of a shard that loses bytes: what is left."""

    def run(key, docs, told):
        digests, texts, again = _distinct(docs)
        rows = told.to_pylist()
        text, first, size = (np.concatenate(c).astype(np.int64) for c in zip(*(_columns(r, 3) for r in rows), strict=True)) \
            if rows else (np.zeros(0, dtype=np.int64),) * 3
        order = np.argsort(text, kind="stable")
        text, first, size = text[order], first[order], size[order]
        out = []
        for k, (digest, t) in enumerate(zip(digests, texts, strict=True)):
            if digest in again:
                gone = np.ones(len(t), dtype=bool)
            else:
                a, b = np.searchsorted(text, [k, k + 1])
                if a == b:
                    continue
                steps = np.zeros(len(t) + 1, dtype=np.int32)
                np.add.at(steps, first[a:b], 1)
                np.add.at(steps, first[a:b] + size[a:b], -1)
                gone = np.cumsum(steps[:-1]) > 0
            kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
            spans = int(np.count_nonzero(np.diff(np.append(0, gone.astype(np.int8))) == 1))
            out.append((digest.hex(), int(gone.sum()), spans, kept if with_bytes else None, sha256_hex(kept)))
        columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * 5
        return pa.Table.from_batches([record_batch(_FOUND, columns)])

    return run


def repeated_bytes(docs: DataFrame, least: int = 400, text: str = "text", crowd: int = 1024, with_bytes: bool = False) -> DataFrame:
    """Of each distinct text that loses bytes: its SHA-256, the bytes and runs
    removed, what is left (with ``with_bytes``) and its SHA-256."""
    if least < GRAM:
        raise ValueError(f"least must be at least {GRAM}")
    shards = ranges = shards_for(docs, text)
    long = docs.select(F.col(text).alias("text")).filter(F.octet_length("text") >= least)
    sharded = long.select(F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"), "text").mapInArrow(
        _collapse(least), _SHARDED)
    by_shard = sharded.groupBy("shard")
    marked = by_shard.applyInArrow(_count_grams(least, ranges), _PACKED)
    told = marked.groupBy("part").applyInArrow(_twice(crowd), _PACKED)
    packed = by_shard.cogroup(told.groupBy("part")).applyInArrow(_contexts(least, ranges), _PACKED)
    repeats = packed.groupBy("kind", "part").applyInArrow(_resolve(least), _PACKED)
    return by_shard.cogroup(repeats.groupBy("part")).applyInArrow(_remove(least, with_bytes), _FOUND)


def remove_repeats(docs: DataFrame, least: int = 400, text: str = "text", digests: bool = False, crowd: int = 1024) -> DataFrame:
    """The documents with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``,
    the bytes left of each text (cuts may fall inside a character); with
    ``digests`` ``kept_sha256`` instead and no text."""
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256" if digests else "kept"]
    docs, names = set_aside(docs.drop(*made), {"_digest", "_plain", "_n_removed", "_n_spans", "_kept", "_kept_sha256"}, (text,))
    found = repeated_bytes(docs, least, text, crowd, with_bytes=not digests).withColumnRenamed("digest", "_digest")
    found = found.select("_digest", *[F.col(c).alias(f"_{c}") for c in found.columns[1:]])
    rows = docs.withColumn("_plain", F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = rows.withColumn("_digest", F.sha2("_plain", 256)).withColumn("n_bytes", F.octet_length("_plain").cast("long"))
    rows = rows.drop("_plain", text) if digests else rows
    joined = rows.join(found, "_digest", "left")
    last = (F.coalesce("_kept_sha256", "_digest").alias("kept_sha256") if digests
            else F.coalesce("_kept", "_plain").alias("kept"))
    return joined.select(*[c for c in docs.columns if not digests or c != text], "n_bytes",
                         F.coalesce("_n_removed", F.lit(0).cast("long")).alias("n_removed"),
                         F.coalesce("_n_spans", F.lit(0).cast("long")).alias("n_spans"), last).withColumnsRenamed(names)
