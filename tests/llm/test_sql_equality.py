"""The queries that SQL can express, against DuckDB over whole small tables."""

import duckdb
import pytest

from vigia.llm import queries as q

TABLES = ("documents", "benchmark", "pages", "labels", "conversations")


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def rows_sql(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rel = con.sql(sql)
    names = sorted(rel.columns)
    return sorted(rel.project(", ".join(names)).fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, name, sf):
    assert rows_of(q.queries()[name](spark, sf)) == rows_sql(sf, q.oracle_sql()[name])


def test_edge_rows_equal_sql(spark, tmpdir_path):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    os.makedirs(tmpdir_path, exist_ok=True)
    texts = [None, "", " \n ", "a b c a b c", "x\nx\n x\n\n\nx", "one two three " * 30, "the of and to " * 5000, "# $ | <>",
             "word " * 13 + "end", "Ünï \x0b\x0ctab\tA1-b2", " ".join(f"k{i}" for i in range(60))]
    ids = list(range(len(texts)))
    texts += [texts[5], texts[5], texts[10], "pre " + texts[10] + " post"]
    ids += [5, 77, -3, None]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "lang": ["en", None, "xx"] * 5,
                             "words": [1] * 15, "contamination": ["c"] * 15}), f"{tmpdir_path}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1, 2, 2, None, 3], pa.int64()),
                             "text": ["K1 k2, k3", texts[10], None, "one two", ""]}), f"{tmpdir_path}/benchmark.parquet")
    roles = ["user", "assistant", None, "system", "", "tool"]
    said = ["Hi.", None, "", "cut", " \n", "Hi.", "So?", "Hi.\r\n"]
    pq.write_table(pa.table({"conv_id": pa.array([None if k % 9 == 8 else k % 9 for k in range(90)], pa.int64()),
                             "turn": pa.array([None if k % 7 == 6 else k // 9 - 2 for k in range(90)], pa.int64()),
                             "role": [roles[k * k % 6] for k in range(90)], "text": [said[k * 5 % 8] for k in range(90)],
                             "audit": ["x"] * 90, "part": [1] * 90}), f"{tmpdir_path}/conversations.parquet")
    for t in ("pages", "labels"):
        pq.write_table(pa.table({"x": [1]}), f"{tmpdir_path}/{t}.parquet")
    for name, sql in q.oracle_sql().items():
        assert rows_of(q.queries()[name](spark, tmpdir_path)) == rows_sql(tmpdir_path, sql), name
    empty = f"{tmpdir_path}/none"
    os.makedirs(empty)
    for t in TABLES:
        pq.write_table(pq.read_table(f"{tmpdir_path}/{t}.parquet").slice(0, 0), f"{empty}/{t}.parquet")
    for name in q.oracle_sql():
        assert rows_of(q.queries()[name](spark, empty)) == []
