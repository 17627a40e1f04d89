"""Curated tables on storage: read, write, register, materialise.

Two layouts.  ``write_tables``: Parquet folders under one base path, one
folder per table, notifications and the children that period queries read
partitioned by month, so a period prunes whole folders.  ``save_bucketed``: catalog tables whose eight
notification-keyed tables are bucketed and sorted on notificacao_id with one
bucket count, so their joins and per-notification aggregates read co-located
buckets instead of shuffling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

CURATED_TABLES = [
    "estado", "municipio", "notificacao", "dados_demograficos", "dados_clinicos",
    "dados_epidemiologicos", "dados_gestao_estrategia", "sintoma", "notificacao_sintoma",
    "teste_laboratorial", "vacina_aplicada",
]

# Children written, like the notifications, in folders by month of the notification.
MONTHLY_CHILDREN = ["dados_demograficos", "dados_clinicos", "teste_laboratorial", "vacina_aplicada"]
# Tables keyed (or children keyed) by notificacao_id: bucketed on it when
# written to the catalog, so their joins and per-notification aggregates need
# no shuffle (same bucket count on every table).
NOTIFICATION_KEYED = ["notificacao", "dados_demograficos", "dados_clinicos", "dados_epidemiologicos",
                      "dados_gestao_estrategia", "notificacao_sintoma", "teste_laboratorial",
                      "vacina_aplicada"]


def read_tables(spark: SparkSession, base: str, names=CURATED_TABLES) -> dict[str, DataFrame]:
    """Lazy frames over curated Parquet tables.

    The month partition column of notifications is kept, so period filters
    can prune folders (see ``plans.indicators``)."""
    return {n: spark.read.parquet(f"{base.rstrip('/')}/{n}") for n in names}


def _months(notificacao: DataFrame) -> DataFrame:
    return notificacao.select("notificacao_id", F.date_format("data_notificacao", "yyyy-MM").alias("mes_particao"))


def write_table(df: DataFrame, base: str, name: str, mode: str = "overwrite", files_per_month: int = 1) -> str:
    """Write one curated table.  Overwrite by default, so a rerun is idempotent
    (the reference appends and a second load breaks its primary keys).

    A table with the column ``mes_particao`` is written in a folder a month, of
    at most ``files_per_month`` files: its rows are dealt by month and a salt
    first, so the number of files does not grow with the number of tasks."""
    path = f"{base.rstrip('/')}/{name}"
    if name == "notificacao" and "mes_particao" not in df.columns:
        df = df.withColumn("mes_particao", F.date_format("data_notificacao", "yyyy-MM"))
    if "mes_particao" not in df.columns:
        df.write.mode(mode).parquet(path)
        return path
    salt = F.pmod(F.xxhash64("notificacao_id"), F.lit(files_per_month))
    df.repartition("mes_particao", salt).write.mode(mode).partitionBy("mes_particao").parquet(path)
    return path


def write_tables(tables: dict[str, DataFrame], base: str, mode: str = "overwrite",
                 files_per_month: int = 1) -> dict[str, str]:
    """Every table; the children that period queries read carry the month of
    their notification, so that a period prunes their folders too."""
    out = {}
    for n, df in tables.items():
        if n in MONTHLY_CHILDREN and "notificacao" in tables and "mes_particao" not in df.columns:
            df = df.join(_months(tables["notificacao"]), "notificacao_id", "left")
        out[n] = write_table(df, base, n, mode, files_per_month)
    return out


def save_bucketed(tables: dict[str, DataFrame], database: str, buckets: int,
                  mode: str = "overwrite", base: str | None = None) -> dict[str, str]:
    """S6 (catalog form): write every table as a managed catalog table; the
    notification-keyed ones bucketed and sorted by notificacao_id into the same
    number of buckets.  Joins between them and groupings by notificacao_id
    then read co-located buckets instead of shuffling both sides.

    Choose ``buckets`` so one bucket of the largest table is a few hundred MB
    (e.g. 4096 at ~1 TB of tests); dimensions are written unbucketed.  Tables
    are stored under ``base`` (default: a folder of the shared checkpoint
    folder), never in a process-local warehouse directory."""
    from ..session import checkpoint_dir
    spark = next(iter(tables.values())).sparkSession
    base = (base or f"{checkpoint_dir(spark)}/catalog/{database}").rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
    out = {}
    for name, df in tables.items():
        full = f"{database}.{name}"
        keyed = name in NOTIFICATION_KEYED
        if keyed:  # one task a bucket, so one file a bucket
            df = df.repartition(buckets, "notificacao_id")
        w = df.write.mode(mode).format("parquet").option("path", f"{base}/{name}")
        if keyed:
            w = w.bucketBy(buckets, "notificacao_id").sortBy("notificacao_id")
        w.saveAsTable(full)
        out[name] = full
    return out


def read_catalog(spark: SparkSession, database: str, names=CURATED_TABLES) -> dict[str, DataFrame]:
    """S5 (catalog form): the curated tables as catalog tables (bucket metadata kept)."""
    return {n: spark.table(f"{database}.{n}") for n in names}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose every frame under its table name for SQL users."""
    for n, df in tables.items():
        df.createOrReplaceTempView(n)


def require_non_empty(df: DataFrame, what: str = "extract") -> DataFrame:
    """Fail when the extract has no row (one cheap limit-1 job)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty (0 rows)")
    return df


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared checkpoint folder and read it back.

    Unlike ``persist``, the written copy survives the loss of executors, and it
    cuts the lineage so later interactive queries do not recompute the joins.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


LOG_BATCH = "lote_carga"


def append_log(df: DataFrame, path: str, batch: str | int | None = None) -> None:
    """Append audit rows, partitioned by affected table.

    With a ``batch`` (a load's or micro-batch's name) the rows go to the folders
    of (table, batch) and replace what is there: a batch that is repeated after
    a failure leaves the log as one run does.  Rows without one are appended."""
    if batch is None:
        df.write.mode("append").partitionBy("tabela_afetada").parquet(path)
        return
    (df.withColumn(LOG_BATCH, F.lit(str(batch))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("tabela_afetada", LOG_BATCH).parquet(path))


def read_log(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The audit log with the columns that were appended."""
    reader = spark.read.option("recursiveFileLookup", "false")
    return (reader.schema(schema) if schema is not None else reader).parquet(path).drop(LOG_BATCH)
