"""Lookup joins of the loader: name -> code recovery maps (J4, J5) and the
data-quality anti joins (C2/C6 helpers).

The maps have one row per distinct municipality name.  They are written once
and joined to the raw rows without a hint: the planner knows the file size and
broadcasts them below its threshold; beyond it the rows meet the map in a
sort-merge join, where AQE splits a name that holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import to_double
from ..functions.geo import MIN_VALID_CODE
from .keys import first_by


def name_code_map(raw: DataFrame, name_col: str, code_col: str, row_id: str) -> DataFrame:
    """One map (name -> numeric code): rows with both fields present, first
    row per name in file order, code read leniently (junk -> null)."""
    pairs = raw.filter(F.col(name_col).isNotNull() & F.col(code_col).isNotNull())
    first = first_by(pairs.select(name_col, code_col, row_id), [name_col], row_id, [code_col])
    return first.select(F.col(name_col).alias("nome"), to_double(code_col).alias("codigo"))


def merge_maps(residence: DataFrame, notification: DataFrame) -> DataFrame:
    """Union of both maps; for a name present in both, the notification
    map wins even when its code is null (precedence by presence)."""
    r = residence.select("nome", F.col("codigo").alias("_r"))
    n = notification.select("nome", F.col("codigo").alias("_n"), F.lit(True).alias("_in_n"))
    j = r.join(n, "nome", "full")
    return j.select("nome", F.when(F.col("_in_n"), F.col("_n")).otherwise(F.col("_r")).alias("codigo"))


def recover_code(df: DataFrame, code_col: str, name_col: str, name_map: DataFrame,
                 out_col: str | None = None) -> DataFrame:
    """Keep a code already above 99999; otherwise take the map's code for
    the row's name when the name is known; otherwise keep the row's value.

    Output is the numeric value (double, null when unparsable), which is all
    later steps look at."""
    out_col = out_col or code_col
    m = name_map.select(F.col("nome").alias("_map_nome"), F.col("codigo").alias("_map_codigo"),
                        F.lit(True).alias("_known"))
    j = df.join(m, F.col(name_col) == F.col("_map_nome"), "left")
    own = to_double(code_col)
    value = (F.when(own > MIN_VALID_CODE, own)
              .when(F.col(name_col).isNotNull() & F.col("_known"), F.col("_map_codigo"))
              .otherwise(own))
    return j.withColumn(out_col, value).drop("_map_nome", "_map_codigo", "_known")


def keyed(df: DataFrame) -> DataFrame:
    """The side of a join that has rows for every notification.

    Such a table grows with the data, but the planner goes by the size of its
    files: a few columns of a compressed table of millions of rows look small
    enough to broadcast, which collects all of them on the driver.  The hint
    keeps the join shuffled whatever that estimate says."""
    return df.hint("merge")


def orphans(child: DataFrame, parent: DataFrame, fk: str | list[str], pk: str | list[str]) -> DataFrame:
    """Rows of ``child`` whose non-null foreign key has no parent (left anti)."""
    fk = [fk] if isinstance(fk, str) else fk
    pk = [pk] if isinstance(pk, str) else pk
    cond = None
    for a, b in zip(fk, pk):
        c = child[a] == parent[b]
        cond = c if cond is None else (cond & c)
    notnull = None
    for a in fk:
        c = F.col(a).isNotNull()
        notnull = c if notnull is None else (notnull & c)
    return child.filter(notnull).join(parent, cond, "left_anti")
