"""Shared pieces of the text operators: table access, Arrow columns, numpy helpers.

Text is handled as UTF-8 bytes wherever the operator allows it: the white
space and symbol classes used here are ASCII, so a byte view splits exactly
where a code-point view would.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One input table, all rows, the named columns only."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def set_aside(docs: DataFrame, helpers: set[str], used: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns that have the name of a helper column renamed, and
    how to name them again; ``used`` columns keep their names."""
    moved = {}
    for c in docs.columns:
        if c in helpers and c not in used:
            new = f"{c}_"
            while new in docs.columns or new in helpers or new in moved.values():
                new += "_"
            moved[c] = new
    return (docs.withColumnsRenamed(moved) if moved else docs), {new: c for c, new in moved.items()}


def shards_for(docs: DataFrame, text: str, shard_bytes: int = 64 << 20) -> int:
    """How many shards hold the texts at ``shard_bytes`` each, at least the
    session's shuffle partitions: a shard does not grow with the input."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))


def bytes_list(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes (nulls stay None)."""
    if pa.types.is_null(column.type):
        return [None] * len(column)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def text_slices(batch: pa.RecordBatch, name: str, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``budget`` text bytes (a longer row
    is a run of its own), so that working arrays stay small whatever the
    batch size."""
    col = batch.column(name)
    n = len(col)
    if n == 0:
        return
    sizes = np.asarray([0 if v is None else len(v) for v in bytes_list(col)], dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + budget, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def record_batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    """Columns (lists, numpy or Arrow arrays) as a record batch of a Spark schema."""
    from pyspark.sql.pandas.types import to_arrow_type
    arrays, names = [], []
    for field, col in zip(schema.fields, columns, strict=True):
        kind = to_arrow_type(field.dataType)
        arrays.append(col.cast(kind) if isinstance(col, pa.Array) else pa.array(col, type=kind))
        names.append(field.name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multipliers), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected components of the links (a[i], b[i]) as stars: every node that
    is not the smallest of its component, with that smallest node."""
    if not len(a):
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]
