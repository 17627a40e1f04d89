"""Raw notification files: read, number rows in file order, export.

Raw columns are read as strings with an explicit schema (no inference) and
the missing-value tokens are turned into nulls by one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import nullify_tokens
from ..session import reliable_checkpoint

# --- fixed values: the 57 raw columns the loader consumes ---------------------
RAW_COLUMNS = [
    "dataNotificacao", "dataInicioSintomas", "dataEncerramento",
    "dataColetaTeste1", "dataColetaTeste2", "dataColetaTeste3", "dataColetaTeste4",
    "dataPrimeiraDose", "dataSegundaDose",
    "municipio", "municipioIBGE", "municipioNotificacao", "municipioNotificacaoIBGE",
    "excluido", "validado", "source_id",
    "idade", "sexo", "racaCor", "profissionalSaude", "profissionalSeguranca", "cbo",
    "codigoContemComunidadeTradicional",
    "classificacaoFinal", "evolucaoCaso", "totalTestesRealizados", "outrosSintomas",
    "outrasCondicoes",
    "codigoEstrategiaCovid", "codigoBuscaAtivaAssintomatico", "outroBuscaAtivaAssintomatico",
    "codigoTriagemPopulacaoEspecifica", "outroTriagemPopulacaoEspecifica",
    "codigoLocalRealizacaoTestagem", "outroLocalRealizacaoTestagem",
    "origem", "sintomas",
    "codigoTipoTeste1", "codigoTipoTeste2", "codigoTipoTeste3", "codigoTipoTeste4",
    "codigoFabricanteTeste1", "codigoFabricanteTeste2", "codigoFabricanteTeste3",
    "codigoFabricanteTeste4",
    "codigoResultadoTeste1", "codigoResultadoTeste2", "codigoResultadoTeste3",
    "codigoResultadoTeste4",
    "codigoEstadoTeste1", "codigoEstadoTeste2", "codigoEstadoTeste3", "codigoEstadoTeste4",
    "codigoLaboratorioPrimeiraDose", "codigoLaboratorioSegundaDose",
    "lotePrimeiraDose", "loteSegundaDose",
]
# ------------------------------------------------------------------------------

_ID_BITS = 33  # monotonically_increasing_id: partition index << 33 | position


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


# Source position columns kept by read_raw (file path, start of the file split).
SOURCE_COLUMNS = ["_src_file", "_src_block"]


#: How raw files quote: a quote inside a field is doubled, a backslash is an
#: ordinary character.
QUOTING = {"quote": '"', "escape": '"', "encoding": "UTF-8"}
MALFORMED = "_malformed"


def _header(spark: SparkSession, path: str, sep: str, multiline: bool) -> list[str]:
    return spark.read.options(header=True, sep=sep, multiLine=multiline, inferSchema=False, **QUOTING).csv(path).columns


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file that a read of ``path`` takes (listing only)."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def read_raw(spark: SparkSession, path: str, columns=None, sep: str = ",",
             multiline: bool = True, with_source: bool = True, malformed: str = "fail",
             max_file_bytes: int = 2 << 30) -> DataFrame:
    """S1 + S2: header CSV, every column a string, NA tokens -> null.

    With ``multiline`` a quoted newline stays inside its record, but a file is
    then read by one task: feed many files (one per day / source).  A file of
    more than ``max_file_bytes`` (as it is stored: a ``.gz`` file by its packed
    size) is refused with the two ways on: cut it into files, or ``multiline=False``, which splits files among tasks and is right
    where no field holds a line end.  Columns are matched by header name; ``columns`` (default:
    the 57 consumed ones) are selected after the read, missing ones as null.
    ``with_source`` keeps each row's file path and split start (from the
    ``_metadata`` column) so rows can be numbered in (file, line) order.

    A record with too few or too many fields is malformed: by default
    (``fail``) reading it raises an error that shows it; ``keep`` leaves its
    text in the column ``_malformed`` (null for good records), to be counted
    and put aside by the caller.
    """
    if malformed not in ("fail", "keep"):
        raise ValueError("malformed is 'fail' or 'keep'")
    if multiline:
        size = largest_file(spark, path)
        if size > max_file_bytes:
            raise ValueError(f"the largest file under {path} has {size} bytes and would be read by one task: cut it into "
                             f"files of at most {max_file_bytes} bytes, or read with multiline=False if no field holds a line end")
    present = _header(spark, path, sep, multiline)
    schema = string_schema([*present, MALFORMED])
    df = (spark.read.schema(schema).options(
        header=True, sep=sep, multiLine=multiline, mode="PERMISSIVE", enforceSchema=True,
        columnNameOfCorruptRecord=MALFORMED, **QUOTING).csv(path))
    cols = columns or RAW_COLUMNS
    src = ([F.col("_metadata.file_path").alias("_src_file"),
            F.col("_metadata.file_block_start").alias("_src_block")] if with_source else [])
    df = df.select(*[F.col(f"`{c}`") if c in present else F.lit(None).cast("string").alias(c) for c in cols],
                   F.col(MALFORMED), *([F.col(f"`{present[0]}`").alias("_first")] if malformed == "fail" else []), *src)
    if malformed == "fail":
        # The error names the record; it needs another column than the corrupt one.
        bad = F.raise_error(F.concat(F.lit("malformed CSV record: "), F.coalesce("_first", F.lit("")), F.lit(" ... "),
                                     F.substring(MALFORMED, 1, 200))).cast("boolean")
        df = df.filter(F.when(F.col(MALFORMED).isNull(), F.lit(True)).otherwise(bad)).drop(MALFORMED, "_first")
        return nullify_tokens(df)
    return nullify_tokens(df.withColumnRenamed(MALFORMED, "_kept")).withColumnRenamed("_kept", MALFORMED)


def count_malformed(spark: SparkSession, path: str, sep: str = ",", multiline: bool = True) -> int:
    """Records of the files that have too few or too many fields."""
    df = read_raw(spark, path, sep=sep, multiline=multiline, malformed="keep")
    return df.select(F.count_if(F.col(MALFORMED).isNotNull()).alias("n"), F.count("dataNotificacao")).first()["n"]


def write_raw(df: DataFrame, path: str, sep: str = ",", compression: str = "none") -> None:
    """Raw rows as CSV files that ``read_raw`` and any RFC 4180 reader take.

    As text they take several times the bytes of the columnar tables that they
    were made from; ``compression="gzip"`` writes ``.csv.gz`` files, which
    ``read_raw`` unpacks as it reads (one task a file, as with ``multiline``)."""
    df.write.mode("overwrite").options(header=True, sep=sep, ignoreLeadingWhiteSpace=False, compression=compression,
                                       ignoreTrailingWhiteSpace=False, **QUOTING).csv(path)


def with_file_order_id(df: DataFrame, name: str = "notificacao_id", start: int = 1,
                       stable: bool = False) -> DataFrame:
    """S3: dense ids start, start+1, ... in file order.

    Rows are cut into segments: one per (file, split start, partition) when
    the frame carries its source columns (``read_raw``), otherwise one per
    partition (key order after a sort).  Rows of a segment are contiguous
    inside their partition, so a row's position is its provisional id minus
    the segment's first one.  Segment sizes are a small aggregate (one row per
    file split or partition, a proven bound); ordered by (file, split start,
    partition) their running sum gives each segment's offset.  The offsets go
    back as one row per partition (its segments' first positions and offsets,
    two longs per split), broadcast.  File order therefore does not depend on how Spark
    packs files into partitions (it packs the largest first).

    The provisional id is materialised first (a table written to the shared
    checkpoint folder) unless the caller says the input is already stable, so
    recomputation after an executor loss cannot renumber rows.
    """
    from pyspark.sql import Window
    seg = [c for c in SOURCE_COLUMNS if c in df.columns]
    pos = df.withColumn("_pos", F.monotonically_increasing_id())
    if not stable:
        pos = reliable_checkpoint(pos)
    pos = pos.withColumn("_part", F.shiftright(F.col("_pos"), _ID_BITS))
    keys = seg + ["_part"]
    segments = pos.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = segments.select("_part", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # One row per partition with its segments' (first position, offset): the
    # broadcast holds two longs per file split, no paths.
    per_part = offsets.groupBy("_part").agg(
        F.array_sort(F.collect_list(F.struct("_first", "_off"))).alias("_segs"))
    out = pos.join(F.broadcast(per_part), "_part")
    # Without source columns a partition is one segment: nothing to search.
    mine = F.element_at(F.filter("_segs", lambda x: x["_first"] <= F.col("_pos")) if seg else F.col("_segs"), -1)
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (mine["_off"] + F.col("_pos") - mine["_first"] + F.lit(start))
                      .cast("bigint").alias(name))


def read_flat(spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = True) -> DataFrame:
    """The ';'-separated feature-table CSV (a UTF-8 BOM header is stripped)."""
    r = spark.read.options(header=True, sep=";", multiLine=multiline, **QUOTING)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def export_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """S7: ';'-separated CSV with header, nulls as empty fields, quotes doubled.

    Written as a folder of part files in parallel (no single-file funnel);
    Spark writes no byte-order mark."""
    df.write.mode("overwrite").options(header=True, sep=sep, nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False,
                                       ignoreTrailingWhiteSpace=False, **QUOTING).csv(path)
