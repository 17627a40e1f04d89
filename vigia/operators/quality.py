"""Table constraints re-expressed as data-quality checks.

A relational store rejects a violating row at insert time; on files the
constraints become reports computed over whole tables: duplicate keys
(grouped counts), orphans (anti joins), nulls and length / range bounds, and
all of them together in one report that reads each table once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import keyed, orphans

# --- fixed values: declared lengths and integer ranges of the curated model ----
VARCHAR_LIMITS = {
    "estado": {"nome": 100, "sigla": 2},
    "municipio": {"nome": 150},
    "notificacao": {"source_id": 100},
    "dados_demograficos": {"sexo": 20, "raca_cor": 50, "is_profissional_saude": 20,
                           "is_profissional_seguranca": 20, "cbo": 200},
    "dados_clinicos": {"classificacao_final": 150, "evolucao_caso": 150},
    "dados_epidemiologicos": {"origem_dados": 100},
    "dados_gestao_estrategia": {"codigo_estrategia_covid": 100, "codigo_busca_ativa_assintomatico": 100,
                                "outro_busca_ativa_assintomatico": 255,
                                "codigo_triagem_populacao_especifica": 100,
                                "outro_triagem_populacao_especifica": 255,
                                "codigo_local_realizacao_testagem": 100,
                                "outro_local_realizacao_testagem": 255},
    "sintoma": {"nome": 200},
    "teste_laboratorial": {"tipo_teste": 150, "fabricante_teste": 255, "resultado_teste": 150,
                           "estado_teste": 100},
    "vacina_aplicada": {"laboratorio": 200, "lote": 100},
    "condicao": {"nome": 200},
    "log_alteracoes": {"tabela_afetada": 50, "operacao": 1, "usuario_db": 50},
}
DECIMAL_COLUMNS = {"indicadores_regionais": {  # (digits, of them after the point)
    "taxa_positividade": (5, 2), "tempo_medio_sintomas_teste": (5, 1),
    "perc_prof_saude_infectados": (5, 2), "media_doses_vacina": (4, 2)}}
NOT_NULL = {"log_alteracoes": ["tabela_afetada", "operacao"]}
SMALLINT_COLUMNS = {"dados_demograficos": ["idade"], "teste_laboratorial": ["numero_sequencial"],
                    "vacina_aplicada": ["dose_numero"]}
SMALLINT_RANGE = (-32768, 32767)
PRIMARY_KEYS = {
    "estado": ["estado_ibge"], "municipio": ["municipio_ibge"], "notificacao": ["notificacao_id"],
    "dados_demograficos": ["notificacao_id"], "dados_clinicos": ["notificacao_id"],
    "dados_epidemiologicos": ["notificacao_id"], "dados_gestao_estrategia": ["notificacao_id"],
    "sintoma": ["sintoma_id"], "notificacao_sintoma": ["notificacao_id", "sintoma_id"],
    "condicao": ["condicao_id"], "notificacao_condicao": ["notificacao_id", "condicao_id"],
}
UNIQUE_KEYS = {"sintoma": ["nome"], "condicao": ["nome"],
               "indicadores_regionais": ["municipio_ibge", "periodo_inicio", "periodo_fim"]}
FOREIGN_KEYS = [  # (child, fk columns, parent, pk columns)
    ("municipio", ["estado_ibge"], "estado", ["estado_ibge"]),
    ("notificacao", ["municipio_notificacao_ibge"], "municipio", ["municipio_ibge"]),
    ("notificacao", ["estado_notificacao_ibge"], "estado", ["estado_ibge"]),
    ("dados_demograficos", ["notificacao_id"], "notificacao", ["notificacao_id"]),
    ("dados_clinicos", ["notificacao_id"], "notificacao", ["notificacao_id"]),
    ("dados_epidemiologicos", ["notificacao_id"], "notificacao", ["notificacao_id"]),
    ("dados_epidemiologicos", ["municipio_residencia_ibge"], "municipio", ["municipio_ibge"]),
    ("dados_epidemiologicos", ["estado_residencia_ibge"], "estado", ["estado_ibge"]),
    ("dados_gestao_estrategia", ["notificacao_id"], "notificacao", ["notificacao_id"]),
    ("notificacao_sintoma", ["notificacao_id"], "notificacao", ["notificacao_id"]),
    ("notificacao_sintoma", ["sintoma_id"], "sintoma", ["sintoma_id"]),
    ("notificacao_condicao", ["notificacao_id"], "notificacao", ["notificacao_id"]),
    ("notificacao_condicao", ["condicao_id"], "condicao", ["condicao_id"]),
    ("indicadores_regionais", ["municipio_ibge"], "municipio", ["municipio_ibge"]),
    ("teste_laboratorial", ["notificacao_id"], "notificacao", ["notificacao_id"]),
    ("vacina_aplicada", ["notificacao_id"], "notificacao", ["notificacao_id"]),
]
# Children removed with their notification (ON DELETE CASCADE).
CASCADE_CHILDREN = ["dados_demograficos", "dados_clinicos", "dados_epidemiologicos",
                    "dados_gestao_estrategia", "notificacao_sintoma", "notificacao_condicao",
                    "teste_laboratorial", "vacina_aplicada"]
# --------------------------------------------------------------------------------

REPORT_COLUMNS = ["verificacao", "tabela", "colunas", "violacoes"]


def column_defaults() -> dict[str, dict[str, Column]]:
    """Declared column defaults of the model."""
    return {
        "notificacao": {"excluido": F.lit(False), "validado": F.lit(False)},
        "log_alteracoes": {"usuario_db": F.expr("current_user()"), "data_hora": F.current_timestamp()},
        "indicadores_regionais": {"data_processamento": F.current_timestamp()},
    }


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """A column the writer did not provide gets its declared default.

    As in SQL, a default applies only to an absent column: an explicit null
    stays null (the loader writes unknown ``excluido`` as null)."""
    out = df
    for c, expr in column_defaults().get(table, {}).items():
        if c not in out.columns:
            out = out.withColumn(c, expr)
    return out


def dq_unique(df: DataFrame, keys: list[str], nulls: str = "equal") -> DataFrame:
    """Key values that occur more than once, with their count.

    ``nulls='equal'`` (primary key) groups null keys together and reports
    them; ``nulls='distinct'`` (UNIQUE) ignores rows with a null key part."""
    src = df
    if nulls == "distinct":
        src = df.dropna(subset=keys)
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dq_orphans(child: DataFrame, parent: DataFrame, fk: list[str], pk: list[str]) -> DataFrame:
    """Child rows whose (non-null) foreign key has no parent row."""
    return orphans(child, parent.select(*pk).distinct(), fk, pk)



def _bounds(table: str, df: DataFrame) -> list[tuple[str, str, Column]]:
    """(check, column, violated) of the declared lengths, ranges and NOT NULLs."""
    has = [c for c in df.columns]
    low, high = SMALLINT_RANGE
    out = [("tamanho", c, F.length(c) > n) for c, n in VARCHAR_LIMITS.get(table, {}).items() if c in has]
    out += [("faixa_smallint", c, (F.col(c) < low) | (F.col(c) > high)) for c in SMALLINT_COLUMNS.get(table, []) if c in has]
    out += [("faixa_decimal", c, F.abs(F.round(c, after)) >= 10 ** (digits - after))
            for c, (digits, after) in DECIMAL_COLUMNS.get(table, {}).items() if c in has]
    out += [("nao_nulo", c, F.col(c).isNull()) for c in [*PRIMARY_KEYS.get(table, []), *NOT_NULL.get(table, [])] if c in has]
    return out


def dq_bounds(table: str, df: DataFrame) -> DataFrame | None:
    """Violation counts of every declared bound of one table, in one pass."""
    checks = _bounds(table, df)
    if not checks:
        return None
    wide = df.agg(*[F.count_if(violated).alias(f"c{i}") for i, (_, _, violated) in enumerate(checks)])
    rows = ", ".join(f"'{kind}', '{table}', '{col}', c{i}" for i, (kind, col, _) in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {rows}) as (verificacao, tabela, colunas, violacoes)")


def _key(columns: list[str]) -> Column:
    """A key as one text: of several columns, each with its length before it."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


BOUND, PARENT = -1, -1


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Q31: every declared constraint of the model as a row (check, table,
    columns, violations).

    Each table is read once.  A row gives a record (key domain, side, key) for
    its primary or unique key, one for each reference that it makes, and one
    for each bound that it breaks.  The records of all tables are counted
    together by domain and key, partially where they lie: a key that its own
    side has more than once is a duplicate, the rows of a reference whose key
    the parent's side lacks are orphans."""
    checks: list[tuple[str, str, str]] = []  # (check, table, columns) by number
    records: dict[str, list[Column]] = {name: [] for name in tables}
    domains: dict[tuple, int] = {}            # (table, key columns) -> number of its uniqueness check

    def add(kind: str, table: str, columns: list[str]) -> int:
        checks.append((kind, table, ",".join(columns)))
        return len(checks) - 1

    def record(domain: int, side: int, key: Column) -> Column:
        return F.struct(F.lit(domain).alias("domain"), F.lit(side).alias("side"), key.alias("key"))

    for kind, declared in (("chave_primaria", PRIMARY_KEYS), ("unico", UNIQUE_KEYS)):
        for table, columns in declared.items():
            if table in tables and set(columns) <= set(tables[table].columns):
                n = domains[(table, tuple(columns))] = add(kind, table, columns)
                own = record(n, PARENT, _key(columns))
                records[table].append(own if kind == "chave_primaria" else F.when(_present(columns), own))
    for child, fk, parent, pk in FOREIGN_KEYS:
        if child in tables and (parent, tuple(pk)) in domains and set(fk) <= set(tables[child].columns):
            n = add("chave_estrangeira", child, fk)
            records[child].append(F.when(_present(fk), record(domains[(parent, tuple(pk))], n, _key(fk))))
    for table, df in tables.items():
        for kind, column, violated in _bounds(table, df):
            n = add(kind, table, [column])
            records[table].append(F.when(violated, record(BOUND, n, F.lit(None).cast("string"))))

    spark = next(iter(tables.values())).sparkSession
    parts = [df.select(F.inline(F.array_compact(F.array(*records[t])))) for t, df in tables.items() if records[t]]
    counted = (reduce(lambda a, b: a.unionByName(b), parts).groupBy("domain", "side", "key").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("domain", "key").agg(
                   F.sum(F.when((F.col("domain") != BOUND) & (F.col("side") == PARENT), F.col("n"))).alias("own"),
                   # At most one entry a check that refers to this domain.
                   F.collect_list(F.when((F.col("domain") == BOUND) | (F.col("side") != PARENT), F.struct("side", "n"))).alias("others")))
    found = counted.select(F.inline(F.array_compact(F.concat(
        F.array(F.when(F.col("own") > 1, F.struct(F.col("domain").alias("check"), F.lit(1).cast("long").alias("n")))),
        F.when(F.col("own").isNull(), F.transform("others", lambda x: F.struct(x["side"].alias("check"), x["n"].alias("n"))))
         .otherwise(F.array().cast("array<struct<check:int,n:bigint>>"))))))
    totals = found.groupBy("check").agg(F.sum("n").alias("n"))
    listed = spark.createDataFrame([(i, *c) for i, c in enumerate(checks)], "check int, verificacao string, tabela string, colunas string")
    return listed.join(totals, "check", "left").select("verificacao", "tabela", "colunas", F.coalesce("n", F.lit(0)).alias("violacoes"))


def delete_notifications(tables: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """Remove notifications and, in cascade, all their child rows.

    ``ids`` holds the notificacao_id values to delete (any size: the removal
    is a left anti join per table on notificacao_id, shuffled by key, not a
    list shipped from the driver)."""
    ids = keyed(ids.select("notificacao_id").distinct())
    out = dict(tables)
    for name in ["notificacao"] + CASCADE_CHILDREN:
        if name in tables:
            out[name] = tables[name].join(ids, "notificacao_id", "left_anti")
    return out
