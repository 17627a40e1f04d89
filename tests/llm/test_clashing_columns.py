"""General forms keep extra columns whatever their names."""

from vigia.llm import pii_surrogates, simhash_variants, substring_dedup, suffix_dedup
from vigia.llm.common import shards_for

LONG = " ".join(f"word{i}" for i in range(200))
HELPERS = ("_fresh", "_key", "_id", "_shard", "_digest", "_plain", "_n_removed", "_kept_")


def table(spark):
    rows = [(i, f"{LONG} mail joe{i}@example.org" if i < 3 else f"own text {i}", *(f"{h}{i}" for h in HELPERS)) for i in range(5)]
    return spark.createDataFrame(rows, ["doc_id", "text", *HELPERS])


def test_extra_columns_stay(spark):
    docs = table(spark)
    for out in (pii_surrogates.replace_entities(docs), substring_dedup.remove_repeats(docs), suffix_dedup.remove_repeats(docs)):
        assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
        rows = out.collect()
        assert len(rows) == 5 and all(r[h] == f"{h}{r['doc_id']}" for r in rows for h in HELPERS)


def test_result_columns_are_replaced(spark):
    docs = table(spark).withColumnsRenamed({"_fresh": "root", "_key": "component_id", "_id": "fp"})
    out = simhash_variants.link_components(docs)
    assert sorted(out.columns) == sorted({*docs.columns} - {"text"}) and {r["component_id"] for r in out.collect()} <= {0, 1, 2, 3, 4}


def test_shards_follow_the_bytes(spark):
    docs = table(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shards_for(docs, "text") == least and shards_for(docs, "text", 100) > 30 and shards_for(docs.limit(0), "text") == least
