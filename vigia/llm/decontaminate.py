"""Benchmark decontamination: windows of words shared with a benchmark.

The benchmark's normalised word windows form a set of hashes that every task
gets by broadcast; a task scans each document's windows against it, verifies
the hits word by word and marks the words they cover.  A window is ``n``
consecutive words; an item of fewer words is one window.

The set is sent in blocks of at most ``block_words`` benchmark words (about
100 MB in a task).  A benchmark within one block, the usual case, takes one
pass without any shuffle; a larger one takes one pass a block, each written to
the shared checkpoint folder, and every item is still held against every
document.

Cases: a null or empty text has no words and is clean; an item without words
has no window; a null item id counts as the id ``null``; equal item ids count
once; repeated document rows are each marked; a documents or benchmark table
without rows gives no rows or no hits.  A column of the documents that has the
name of the result column is replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_type

from ..session import reliable_checkpoint
from .common import bytes_list

RESULT = "contamination"
RESULT_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("hits", T.BinaryType()),  # one bit a word, first word first
])

#: ASCII letters in lower case and digits stay, other ASCII separates words;
#: bytes of 0x80 and over (every non-ASCII code point) belong to words.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


def _hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of n ids."""
    x = ids.astype(np.uint64)
    out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = out * _BASE + x[j: j + len(out)] + np.uint64(1)
    return out


class WindowSet:
    """Windows of a block of items: by window length, sorted hashes, the word
    ids for the check of a hit, and the items that hold the window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int):
        self.vocab: dict[bytes, int] = {}
        found: dict[int, dict[bytes, set[str]]] = {}
        for item, words in items:
            if not words:
                continue
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words], dtype=np.int32)
            size = min(n, len(ids))
            for k in range(len(ids) - size + 1):
                found.setdefault(size, {}).setdefault(ids[k: k + size].tobytes(), set()).add(item)
        self.by_length = {}
        for size, windows in found.items():
            ids = np.frombuffer(b"".join(windows), dtype=np.int32).reshape(-1, size)
            hashes = np.concatenate([_hashes(row, size) for row in ids])
            self.by_length[size] = np.unique(hashes), {k: sorted(v) for k, v in windows.items()}

    def mark(self, words: list[bytes], hit: np.ndarray, items: set[str]) -> None:
        """Set ``hit`` for the words that windows cover, add the items found."""
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int32, count=len(words))
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for size, (hashes, windows) in self.by_length.items():
            if len(ids) < size:
                continue
            starts = np.flatnonzero(unknown[size:] == unknown[:-size])  # of windows of known words
            if not len(starts):
                continue
            seen = _hashes(ids, size)[starts] if len(starts) * 4 > len(ids) else np.concatenate(
                [_hashes(ids[s: s + size], size) for s in starts])
            at = np.minimum(np.searchsorted(hashes, seen), len(hashes) - 1)
            for s in starts[hashes[at] == seen]:
                holders = windows.get(ids[s: s + size].tobytes())
                if holders:
                    hit[s: s + size] = True
                    items.update(holders)


def _blocks(benchmark: DataFrame, item_id: str, text: str, n: int, block_words: int):
    """The benchmark as window sets of bounded size, read item by item."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"),
                            F.col(text).alias("t"))
    for row in rows.toLocalIterator():
        words = normal_words(row["t"].encode() if row["t"] is not None else None)
        if block and size + len(words) > block_words:
            yield WindowSet(block, n)
            block, size = [], 0
        block.append((row["i"], words))
        size += len(words)
    yield WindowSet(block, n)


def mark_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text",
                       block_words: int = 250_000, keep_text: bool = True, result: str = RESULT) -> DataFrame:
    """The documents with a struct column ``contamination`` (or ``result``):
    words, words hit, the items found (sorted as strings) and a bit for each word.

    ``keep_text=False`` leaves out the text column of the result."""
    spark = docs.sparkSession
    out = docs.drop(result).withColumn(result, F.lit(None).cast(RESULT_TYPE))
    blocks = _blocks(benchmark, item_id, item_text, n, block_words)
    held = next(blocks)
    while held is not None:
        following = next(blocks, None)
        last = following is None
        schema = T.StructType([f for f in out.schema.fields if keep_text or not last or f.name != text])
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(held), text, schema, result), schema)
        if not last:
            out = reliable_checkpoint(out, "contamination")
        held = following
    return out


def _scan(windows, text: str, schema: T.StructType, result: str):
    names = schema.names

    def run(batches):
        known = windows.value
        kind = to_arrow_type(schema[result].dataType)
        for batch in batches:
            rows = []
            for t, before in zip(bytes_list(batch.column(text)), batch.column(result).to_pylist(), strict=True):
                words = normal_words(t)
                hit, items = np.zeros(len(words), dtype=bool), set()
                if before:
                    hit |= np.unpackbits(np.frombuffer(before["hits"], np.uint8), count=len(words)).astype(bool)
                    items.update(before["items"])
                known.mark(words, hit, items)
                rows.append({"n_words": len(words), "n_hit": int(hit.sum()), "items": sorted(items),
                             "hits": np.packbits(hit).tobytes()})
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, type=kind) if c == result else batch.column(c) for c in names], names=names)

    return run


def _free_name(docs: DataFrame) -> str:
    name = RESULT
    while name in docs.columns:
        name += "_"
    return name


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, without those that hold any
    benchmark window."""
    found = _free_name(docs)
    marked = mark_contamination(docs, benchmark, result=found, **options)
    return marked.filter(F.col(f"{found}.n_hit") == 0).drop(found)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents; the hit words are cut out of the texts, the rest of each
    text stays as it is."""
    found = _free_name(docs)
    marked = mark_contamination(docs, benchmark, text=text, result=found, **options)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, bytes(h)) for t, h in zip(texts, hits, strict=True)])

    return marked.withColumn(text, F.when(F.col(f"{found}.n_hit") > 0, cut(F.coalesce(text, F.lit("")), F.col(f"{found}.hits")))
                             .otherwise(F.col(text))).drop(found)


def cut_words(text: str, bits: bytes) -> str:
    """``text`` without the words whose bit is set."""
    data = text.encode()
    plain = np.frombuffer(data.translate(_NORMAL), np.uint8) != 32
    edges = np.diff(np.concatenate([[0], plain.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(starts)).astype(bool)
    keep = np.ones(len(data), dtype=bool)
    for s, e in zip(starts[hit], ends[hit], strict=True):
        keep[s:e] = False
    return np.frombuffer(data, np.uint8)[keep].tobytes().decode()
