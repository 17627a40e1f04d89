"""From raw documents to token ids, in five stages.

Each stage is a function of (session, its predecessor's documents, the folder
of the input tables) and calls one operator of ``vigia.llm``.  What a stage
returns is written as Parquet to the shared checkpoint folder and read again
as the next one's documents.

1. quality classifier: documents that it rejects go;
2. SimHash near-dedup: one document of each group stays;
3. benchmark decontamination: documents with a benchmark window go;
4. PII: entities get surrogates;
5. SentencePiece: the ids of each text, with begin and end ids, and the text
   that they decode to.

All but the last return the columns they were given.  Nulls, empty texts,
repeated rows and empty tables are defined by the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigia.llm import decontaminate, pii_surrogates, quality_gbt, queries, sentencepiece_bpe, simhash_variants
from vigia.llm.common import read_table
from vigia.session import reliable_checkpoint


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_gbt.keep_good(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_variants.keep_one(docs, shingle=3, max_distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace_entities(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode(docs.select("doc_id", "text"), queries.tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII surrogates", pii),
    ("SentencePiece encoding", tokens),
]

#: Trees, fingerprints and tokens are beyond SQL: the stages are tested against
#: brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = reliable_checkpoint(docs, "pipeline")
    return docs
