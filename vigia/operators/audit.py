"""Row-change audit (U2) and change-event logging (U3 core).

The reference logs every INSERT / UPDATE / DELETE with the old and new row
images from a row trigger.  Files have no triggers, so the same log is
produced from data:

* ``audit_diff``: between two versions of a table (full outer join on the
  key; a row only in the new version is an I, only in the old a D, in both
  with any column changed a U).  Updates that change nothing are invisible to
  a diff (the trigger would log them).
* ``audit_multiset``: the same for a table whose rows have no unique key, as a
  difference of multisets; deleted and inserted rows of one group are paired
  into updates by their rank.
* ``purge_log``: the D rows of deleted notifications and of the children that
  go with them.
* ``change_log``: from a stream of change events that carry the new image,
  with the old image taken from the key's previous event.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonrow import row_json
from .joins import keyed
from .sequence import previous_by_key, running_total_by_key

LOG_COLUMNS = ["tabela_afetada", "operacao", "usuario_db", "data_hora", "dados_antigos", "dados_novos"]

# --- fixed values: the audited tables, with the key of their rows ---------------
AUDITED_TABLES = ["notificacao", "teste_laboratorial", "dados_clinicos"]
# Groups in which a deleted and an inserted row count as an update.
SLOT_OF = {"teste_laboratorial": ["notificacao_id", "numero_sequencial"],
           "vacina_aplicada": ["notificacao_id", "dose_numero"]}
KEY_OF = {"notificacao": ["notificacao_id"], "dados_clinicos": ["notificacao_id"], "dados_demograficos": ["notificacao_id"]}
# ---------------------------------------------------------------------------------
CHANGED = "colunas_alteradas"


def _with_meta(df: DataFrame, with_meta: bool) -> DataFrame:
    if not with_meta:
        return df
    more = [c for c in df.columns if c == CHANGED]
    return df.select("tabela_afetada", "operacao", F.expr("current_user()").alias("usuario_db"),
                     F.current_timestamp().alias("data_hora"), "dados_antigos", "dados_novos", *more)


def _images(columns: list[str], struct: str) -> Column:
    return row_json(*[F.col(f"{struct}.{c}").alias(c) for c in columns])


def _log_rows(pairs: DataFrame, old_columns: list[str], new_columns: list[str], keys: list[str], table: str,
              with_meta: bool, with_changes: bool) -> DataFrame:
    """Log rows from pairs of images (``_old``, ``_new``; null where there is none)."""
    differs = {}
    for c in dict.fromkeys([*old_columns, *new_columns]):
        if c not in keys:
            # A column that one version lacks counts as null there.
            before = F.col(f"_old.{c}") if c in old_columns else F.lit(None)
            after = F.col(f"_new.{c}") if c in new_columns else F.lit(None)
            differs[c] = ~before.eqNullSafe(after)
    names = F.array_compact(F.array(*[F.when(d, F.lit(c)) for c, d in differs.items()])) if differs else F.array().cast("array<string>")
    op = (F.when(F.col("_old").isNull(), F.lit("I")).when(F.col("_new").isNull(), F.lit("D"))
           .when(F.size(names) > 0, F.lit("U")))
    out = (pairs.withColumn("operacao", op).filter(F.col("operacao").isNotNull())
           .select(F.lit(table).alias("tabela_afetada"), "operacao",
                   F.when(F.col("operacao") != "I", _images(old_columns, "_old")).alias("dados_antigos"),
                   F.when(F.col("operacao") != "D", _images(new_columns, "_new")).alias("dados_novos"),
                   F.when(F.col("operacao") == "U", names).alias(CHANGED)))
    out = out if with_changes else out.drop(CHANGED)
    return _with_meta(out, with_meta)


def audit_diff(old: DataFrame, new: DataFrame, keys: list[str], table: str,
               with_meta: bool = True, with_changes: bool = False) -> DataFrame:
    """I/U/D log rows with JSON images (nulls kept) between two versions.

    Each image has the columns of its own version, so added and dropped columns
    are seen and logged.  ``with_changes`` adds the names of the columns that a
    U row changes, told from the rows themselves, not from the images.  Both
    versions are shuffled on the key once; the key is unique per version, so no
    key is hot on either side."""
    o = old.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], F.struct(*[F.col(c) for c in old.columns]).alias("_old"))
    n = new.select(*[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)], F.struct(*[F.col(c) for c in new.columns]).alias("_new"))
    same = [F.col(f"_o{i}") == F.col(f"_n{i}") for i in range(len(keys))]
    return _log_rows(o.join(n, same, "full"), old.columns, new.columns, keys, table, with_meta, with_changes)


def audit_multiset(old: DataFrame, new: DataFrame, group: list[str], table: str,
                   with_meta: bool = True, with_changes: bool = False) -> DataFrame:
    """U2 for a table without a unique key: the difference of two multisets.

    Equal rows of both versions cancel by signed counts (grouped by the whole
    row, so partially aggregated where they lie).  What is left is ranked inside
    its group, deleted and inserted rows apart, in the order of the other
    columns; a deleted and an inserted row of one group and rank are one U, the
    rest are D and I.  Ranks are running totals of the counts over range
    partitions, so that neither a group nor a row that repeats is collected.

    Both images have the columns of both versions; a column that one version
    lacks is null there."""
    columns = list(dict.fromkeys([*new.columns, *old.columns]))
    kinds = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns],
                         F.lit(sign).cast("long").alias("_sign"))

    net = signed(old, -1).unionByName(signed(new, 1)).groupBy(*columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    counted = net.select(*columns, F.when(F.col("_net") > 0, "I").otherwise("D").alias("_side"), F.abs("_net").alias("_n"))
    order = [c for c in columns if c not in group]
    ranked = running_total_by_key(counted, [*group, "_side"], order, "_n", "_to")
    each = ranked.withColumn("_rank", F.explode(F.sequence(F.col("_to") - F.col("_n") + 1, F.col("_to"))))

    def side(op: str, image: str, mark: str) -> DataFrame:
        return each.filter(F.col("_side") == op).select(
            *[F.col(g).alias(f"{mark}{i}") for i, g in enumerate(group)], F.col("_rank").alias(f"{mark}r"),
            F.struct(*[F.col(c) for c in columns]).alias(image))

    o, n = side("D", "_old", "_o"), side("I", "_new", "_n")
    same = [F.col(f"_o{i}").eqNullSafe(F.col(f"_n{i}")) for i in range(len(group))] + [F.col("_or") == F.col("_nr")]
    return _log_rows(o.join(n, same, "full"), columns, columns, group, table, with_meta, with_changes)


def audit_tables(old: dict[str, DataFrame], new: dict[str, DataFrame], names: list[str] = AUDITED_TABLES,
                 with_meta: bool = True, with_changes: bool = False) -> DataFrame:
    """The change log of several tables between two versions of the model."""
    parts = [audit_multiset(old[n], new[n], SLOT_OF[n], n, with_meta, with_changes) if n in SLOT_OF
             else audit_diff(old[n], new[n], KEY_OF[n], n, with_meta, with_changes) for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)


def purge_log(tables: dict[str, DataFrame], ids: DataFrame, names: list[str] = AUDITED_TABLES,
              key: str = "notificacao_id", with_meta: bool = True) -> DataFrame:
    """The log of a cascade delete: a D row with its image for every deleted
    notification and for every row of the audited children that goes with it.

    ``ids`` is any size: each table is cut to it by a semi join on the key."""
    ids = keyed(ids.select(key).distinct())
    parts = [df.join(ids, key, "left_semi").select(
        F.lit(n).alias("tabela_afetada"), F.lit("D").alias("operacao"), row_json(*[F.col(c) for c in df.columns]).alias("dados_antigos"),
        F.lit(None).cast("string").alias("dados_novos")) for n, df in tables.items() if n in names]
    return _with_meta(reduce(lambda a, b: a.unionByName(b), parts), with_meta)


def logged_key(key: str = "notificacao_id") -> Column:
    """The key in a log row's image (the new one, else the old)."""
    return F.get_json_object(F.coalesce("dados_novos", "dados_antigos"), f"$.{key}").cast("long")


def changed_keys(log: DataFrame, key: str = "notificacao_id") -> DataFrame:
    """The keys of the rows that a change log names."""
    return log.select(logged_key(key).alias(key)).filter(F.col(key).isNotNull()).distinct()


def change_log(events: DataFrame, key: str, order: list[str], op: Column, image: Column,
               table: str, with_meta: bool = True) -> DataFrame:
    """U3 core: one log row per change event.

    ``op`` gives I/U/D per event, ``image`` the row image after an I/U (JSON
    text).  The old image of a U/D is the previous event's image of the same
    key, unless that event deleted the row."""
    ev = events.select(*dict.fromkeys([key, *order]), op.alias("_op"), image.alias("_image"))
    prev = previous_by_key(ev, key, list(order), ["_op", "_image"])
    old = F.when(F.col("prev__op").isNotNull() & (F.col("prev__op") != "D"), F.col("prev__image"))
    out = prev.select(
        F.lit(table).alias("tabela_afetada"), F.col("_op").alias("operacao"),
        F.when(F.col("_op") != "I", old).alias("dados_antigos"),
        F.when(F.col("_op") != "D", F.col("_image")).alias("dados_novos"))
    return _with_meta(out, with_meta)
