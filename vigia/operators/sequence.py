"""Ordered work inside a key, without putting a hot key in one task.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task;
a key holding a third of the data would then be a third of the job in one
task.  Here rows are range-partitioned and sorted on (key, order) instead, so
a hot key's rows are spread over many partitions by their order value.  One
pass over the sorted rows (Arrow batches) does the work inside a partition and
marks its first and last row; the result is written once.  What a partition
needs from the ones before it follows from those marked rows, one or two a
partition.

* ``previous_by_key``: values of the previous row of the same key;
* ``running_total_by_key``: running sum of a number inside the key.

Nulls: a null key is a key; keys and order columns may be of any orderable
type that Arrow can compare.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint


def _sorted(df: DataFrame, by: list[str], num_partitions: int | None) -> DataFrame:
    # Without an explicit count AQE may merge adjacent range partitions to
    # its target size (order is kept); a hot key still spans many of them.
    cols = [F.col(c) for c in by]
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def _same_as_before(batch: pa.RecordBatch, keys: list[str], before: pa.RecordBatch | None) -> np.ndarray:
    """For each row: does the row before it (the first row's: ``before``) have the same key?"""
    n = batch.num_rows
    same = np.ones(n, dtype=bool)
    for k in keys:
        col = batch.column(k)
        if n > 1:
            a, b = col.slice(0, n - 1), col.slice(1)
            equal = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
            nulls = pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
            same[1:] &= equal | nulls
        same[0] &= before is not None and before.column(k)[0].as_py() == col[0].as_py()
    return same


def _with_lookahead(batches):
    held = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield held, False
            held = batch
    if held is not None:
        yield held, True


def _edges(n: int, first: bool, last: bool) -> tuple[np.ndarray, np.ndarray]:
    head, tail = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    head[0], tail[-1] = first, last
    return head, tail


def _null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]):
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def previous_by_key(df: DataFrame, key: str, order: list[str], values: list[str],
                    prefix: str = "prev_", num_partitions: int | None = None) -> DataFrame:
    """Add ``prefix + v`` for each v in ``values``: the value on the previous
    row (by ``order``) of the same ``key``, null on a key's first row.

    ``values`` are string columns (images, labels).  One range shuffle; the
    first row of each partition alone is joined to the last row of the one
    before it."""
    columns = df.columns
    out = [prefix + v for v in values]
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.StringType()) for c in out],
                           T.StructField("_pid", T.IntegerType()), T.StructField("_head", T.BooleanType()),
                           T.StructField("_tail", T.BooleanType())])

    def run(batches):
        pid, before = TaskContext.get().partitionId(), None
        for batch, last in _with_lookahead(batches):
            n, same = batch.num_rows, _same_as_before(batch, [key], before)
            shifted = []
            for v in values:
                col = batch.column(v)
                first = pa.array([None if before is None else before.column(v)[0].as_py()], col.type)
                moved = pa.concat_arrays([first, col.slice(0, n - 1)])
                shifted.append(pc.if_else(pa.array(same), moved, pa.scalar(None, col.type)))
            head, tail = _edges(n, before is None, last)
            before = batch.slice(n - 1, 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], *shifted, pa.array(np.full(n, pid, np.int32)), pa.array(head), pa.array(tail)],
                names=schema.names)

    passed = reliable_checkpoint(_sorted(df, [key, *order], num_partitions).mapInArrow(run, schema), "previous-rows")
    # One row a partition: the last row of the nearest non-empty partition before.
    w = Window.orderBy("_pid")
    carry = (passed.filter("_tail").select("_pid", F.struct(F.col(key).alias("k"), *[F.col(v) for v in values]).alias("_row"))
             .select(F.col("_pid").alias("_cpid"), F.lag("_row").over(w).alias("_row")).filter(F.col("_row").isNotNull()))
    heads = passed.filter("_head")
    heads = heads.join(carry, heads["_pid"] == carry["_cpid"], "left")
    same = F.col("_row").isNotNull() & F.col("_row.k").eqNullSafe(F.col(key))
    heads = heads.select(*columns, *[F.when(same, F.col(f"_row.{v}").cast("string")).alias(prefix + v) for v in values])
    return passed.filter(~F.col("_head")).select(*columns, *out).unionByName(heads)


def running_total_by_key(df: DataFrame, keys: list[str], order: list[str], value: str, name: str,
                         num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: the sum of the integer column ``value`` over the rows of
    the same keys up to and with this one, by ``order`` (which tells the rows of
    a key apart)."""
    columns = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType()), T.StructField("_pid", T.IntegerType()),
                           T.StructField("_first_key", T.BooleanType()), T.StructField("_head", T.BooleanType()),
                           T.StructField("_tail", T.BooleanType())])

    def run(batches):
        pid, before, total, in_first = TaskContext.get().partitionId(), None, 0, True
        for batch, last in _with_lookahead(batches):
            n, same = batch.num_rows, _same_as_before(batch, keys, before)
            v = pc.fill_null(batch.column(value), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.cumsum(v)
            starts = np.flatnonzero(~same)
            base = np.zeros(n, dtype=np.int64)
            base[starts] = sums[starts] - v[starts]
            group = np.cumsum(~same)  # 0: goes on from the batch before
            base = np.where(group == 0, -total, base[starts[group - 1]] if len(starts) else 0)
            run_sum = sums - base
            first = (group == 0) & in_first if before is not None else group == 1
            in_first = bool(first[-1])
            head, tail = _edges(n, before is None, last)
            total, before = int(run_sum[-1]), batch.slice(n - 1, 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(run_sum), pa.array(np.full(n, pid, np.int32)), pa.array(first),
                 pa.array(head), pa.array(tail)], names=schema.names)

    passed = reliable_checkpoint(_sorted(df, [*keys, *order], num_partitions).mapInArrow(run, schema), "running-totals")
    # Two rows a partition: what its last key has there, and its first key's question.
    marks = (passed.filter("_tail").select(*keys, "_pid", F.lit(1).alias("_kind"), F.col(name).alias("_sum"))
             .unionByName(passed.filter("_head").select(*keys, "_pid", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_sum"))))
    w = Window.partitionBy(*keys).orderBy("_pid", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    carry = (marks.withColumn("_carry", F.sum("_sum").over(w)).filter((F.col("_kind") == 0) & (F.col("_carry") > 0))
             .select("_pid", "_carry"))
    # Two numbers a partition.
    return (passed.join(F.broadcast(carry), "_pid", "left")
            .select(*columns, (F.col(name) + F.when(F.col("_first_key"), F.coalesce("_carry", F.lit(0))).otherwise(0)).alias(name)))
