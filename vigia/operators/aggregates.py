"""Aggregation building blocks.

Everything here is a declarative aggregate, so Spark runs it as partial
(map-side) aggregation followed by one shuffle of the partial results: a key
holding a third of the rows costs one partial row per input partition, never
a third of the data in one task.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_where(pred: Column) -> Column:
    """A2: COUNT(*) FILTER (WHERE pred); a null predicate is not counted."""
    return F.count_if(pred)


def any_flag(pred: Column) -> Column:
    """A4: MAX(CASE WHEN pred THEN 1 ELSE 0 END)."""
    return F.max(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


def concat_ordered(c, sep: str) -> Column:
    """STRING_AGG(c, sep ORDER BY c) in binary order; null when no value.

    Per group the list is bounded (symptoms of one notification)."""
    arr = F.array_sort(F.collect_list(_c(c)))
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def concat_distinct(c, sep: str) -> Column:
    """STRING_AGG(DISTINCT c, sep), sorted; null when no value."""
    arr = F.array_sort(F.collect_set(_c(c)))
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """Counts of non-null values (pandas value_counts)."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(name))


def order_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """Presentation order: count descending, ties by value ascending."""
    return df.orderBy(F.col(name).desc(), F.col(c).asc())


def top_k(df: DataFrame, c: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values (the limit is the report itself).

    Planned as TakeOrderedAndProject over the aggregated counts: each task
    keeps its local top k, the driver merges k rows per task."""
    return order_counts(value_counts(df, c, name), c, name).limit(k)


def shares(df: DataFrame, c: str, name: str = "share", digits: int | None = None) -> DataFrame:
    """value_counts(normalize=True).  The total is a scalar subquery,
    computed once by its own distributed job, not a window or a cross join."""
    total = df.filter(F.col(c).isNotNull()).select(F.count(F.lit(1))).scalar()
    counts = value_counts(df, c, "_n")
    share = F.col("_n").cast("double") / total.cast("double")
    if digits is not None:
        share = F.round(share, digits)
    return counts.select(c, share.alias(name))


def pairwise_corr(x: Column, y: Column) -> Column:
    """Pearson r on rows where both values are present (pandas corr).

    covar_pop / (stddev_pop * stddev_pop) with try_divide, so a constant column
    gives null instead of an ANSI divide-by-zero (``corr`` raises there)."""
    both = x.isNotNull() & y.isNotNull()
    xb, yb = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xb, yb), F.stddev_pop(xb) * F.stddev_pop(yb))


def corr_matrix(df: DataFrame, cols: dict[str, str], digits: int | None = None) -> DataFrame:
    """Long-form correlation matrix (var1, var2, r), one aggregation pass.

    ``cols`` maps output names to column names.  The aggregation computes the
    n(n+1)/2 distinct pairs; the symmetric half is produced by a stack."""
    names = list(cols)
    aggs = []
    for i, j in combinations_with_replacement(range(len(names)), 2):
        r = pairwise_corr(F.col(cols[names[i]]).cast("double"), F.col(cols[names[j]]).cast("double"))
        aggs.append((r if digits is None else F.round(r, digits)).alias(f"r_{i}_{j}"))
    wide = df.agg(*aggs)
    rows = []
    for i in range(len(names)):
        for j in range(len(names)):
            a, b = min(i, j), max(i, j)
            rows.append(f"'{names[i]}', '{names[j]}', r_{a}_{b}")
    stack = f"stack({len(rows)}, {', '.join(rows)}) as (var1, var2, r)"
    return wide.selectExpr(stack)


#: Relative standard error of a distinct count from a sketch of 2^14 registers.
SKETCH_BITS, SKETCH_ERROR = 14, 1.04 / 2 ** 7


def distinct_sketches(df: DataFrame, keys: list[str], c: str, name: str = "esboco") -> DataFrame:
    """A15 at scale: a mergeable distinct-count sketch of a column for each group
    (fixed size, so a group costs the same whatever its rows)."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias(name))


def distinct_from_sketches(sketches: DataFrame, keys: list[str], name: str = "esboco", out: str = "distintos") -> DataFrame:
    """Distinct counts of coarser groups from the sketches of finer ones, without
    the rows: the union of sketches is the sketch of the union."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(name)).alias(out))
