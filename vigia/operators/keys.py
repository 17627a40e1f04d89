"""Deterministic first-by-order dedup and surrogate keys.

``dropDuplicates`` keeps an arbitrary row; these keep the first row by an
explicit order column (file row id, source rank), as the loader's
``drop_duplicates`` keeps the first row in file order.  All of them are
declarative aggregates, which aggregate partially before the shuffle: a key with a third of all rows does not become one heavy task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def first_by(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """For each key (null is one), the ``values`` of the row with the
    smallest ``order``, a number that tells all rows apart.

    The smallest number of each key is a hash aggregate (numbers only, no sort
    of the rows); it is written once, so the semi join that fetches the values
    knows its size: a broadcast for a dimension, a shuffle by row number, which
    cannot be skewed, beyond the planner's bound."""
    first = reliable_checkpoint(df.groupBy(*keys).agg(F.min(order).alias("_first")).select("_first"), "first-rows")
    return df.join(first, F.col(order) == F.col("_first"), "left_semi").select(*keys, *values)


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Full-row dedup on the given columns (a map-side partial distinct)."""
    return df.select(*cols).dropDuplicates(cols)


def dense_ids_by_first_appearance(items: DataFrame, name_col: str, order: list[str],
                                  id_col: str, start: int = 1) -> DataFrame:
    """K1: number distinct names start, start+1, ... in order of first appearance.

    First appearance per name is a partial aggregate over all rows.  The
    distinct names are then range-sorted by it (a distributed sort) and
    numbered with per-partition counts and offsets, so no single task ever
    holds the whole vocabulary, however many distinct spellings the raw
    text contains."""
    from ..sources.raw import with_file_order_id
    first = (items.filter(F.col(name_col).isNotNull()).groupBy(name_col)
             .agg(F.min(F.struct(*[F.col(o) for o in order])).alias("_appear")))
    ranked = with_file_order_id(first.orderBy("_appear"), id_col, start=start)
    return ranked.select(F.col(id_col).cast("int").alias(id_col), name_col)


def extend_ids(known: DataFrame, items: DataFrame, name_col: str, order: list[str], id_col: str) -> DataFrame:
    """K1 over several loads: the dictionary ``known`` (id_col, name_col) with the
    names that a later load brings.  Given ids stay; new names are numbered from
    the largest id on, by first appearance.  Loading files one after the other
    gives the ids that one load of all of them would give."""
    top = known.agg(F.max(id_col)).first()[0] or 0  # one number
    names = known.select(F.col(name_col).alias("_known")).distinct()
    fresh = items.join(names, F.col(name_col) == F.col("_known"), "left_anti")
    new = dense_ids_by_first_appearance(fresh, name_col, order, id_col, start=top + 1)
    return known.select(id_col, name_col).unionByName(new.select(id_col, name_col))


def with_rank(df: DataFrame, order: list, name: str = "ordem") -> DataFrame:
    """The rows with their place 1, 2, ... in an order that tells all rows apart:
    a distributed sort, numbered by counts and offsets of its partitions."""
    from ..sources.raw import with_file_order_id
    return with_file_order_id(df.orderBy(*order), name)
