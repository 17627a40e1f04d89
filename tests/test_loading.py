"""Raw CSV quoting and malformed records, dates and rounding, stream restarts,
audits across schema changes."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from vigia.functions.cleaning import as_smallint, out_of_range
from vigia.functions.dates import parse_date
from vigia.operators.audit import audit_diff
from vigia.plans import cdc
from vigia.sources import raw
from vigia.streaming.audit_stream import audit_stream, read_log

TEXTS = ['He said ""hi"", ok', 'ends with \\', 'a, "b"\nsecond line', "", '\\"', "  spaced  ", 'plain', '"', "é;ç"]


def test_raw_and_export_round_trip(spark, tmpdir_path):
    pdf = pd.DataFrame({"dataNotificacao": [f"2024-01-0{k + 1}" for k in range(len(TEXTS))], "outrosSintomas": TEXTS})
    os.makedirs(f"{tmpdir_path}/p")
    pdf.to_csv(f"{tmpdir_path}/p/raw.csv", index=False)
    got = raw.read_raw(spark, f"{tmpdir_path}/p", columns=list(pdf.columns), with_source=False).collect()
    assert {r[0]: r[1] for r in got} == {a: b or None for a, b in pdf.itertuples(index=False)}
    df = spark.createDataFrame(pdf)
    raw.write_raw(df, f"{tmpdir_path}/w")
    raw.export_csv(df, f"{tmpdir_path}/e")
    back = pd.concat([pd.read_csv(f"{tmpdir_path}/w/{f}", keep_default_na=False)
                      for f in os.listdir(f"{tmpdir_path}/w") if f.endswith(".csv")])
    assert dict(back.values) == dict(pdf.values)
    flat = {r[0]: r[1] or "" for r in raw.read_flat(spark, f"{tmpdir_path}/e").collect()}
    assert flat == dict(pdf.values)


def test_malformed_records_fail_or_are_kept(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/m")
    with open(f"{tmpdir_path}/m/a.csv", "w") as f:
        f.write('dataNotificacao,idade,sexo\n2024-01-01,1,M\n2024-01-02,2\n2024-01-03,3,F,extra\n2024-01-04,4,"x,y"\n')
    cols = ["dataNotificacao", "idade", "sexo"]
    with pytest.raises(Exception, match="malformed CSV record"):
        raw.read_raw(spark, f"{tmpdir_path}/m", columns=cols).collect()
    with pytest.raises(Exception, match="malformed CSV record"):
        raw.read_raw(spark, f"{tmpdir_path}/m", columns=cols).count()
    kept = raw.read_raw(spark, f"{tmpdir_path}/m", columns=cols, malformed="keep").cache()
    assert kept.count() == 4 and kept.filter(F.col(raw.MALFORMED).isNotNull()).count() == 2
    assert raw.count_malformed(spark, f"{tmpdir_path}/m") == 2


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_dates_do_not_shift_with_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-05T23:30:00.000Z",), ("2024-03-05 00:10:00",), ("05/03/2024",),
                                    ("2024-03-05T99:00:00Z",)], "x string")
        got = [str(r[0]) for r in df.select(parse_date("x")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-03-05"] * 3 + ["None"]


def test_rounding_and_range(spark):
    df = spark.createDataFrame([(x,) for x in ("0.5", "1.5", "2.5", "-2.5", "32767.4", "32767.5", "x", None)], "x string")
    assert [r[0] for r in df.select(as_smallint("x")).collect()] == [1, 2, 3, -3, 32767, None, None, None]
    assert [r[0] for r in df.select(out_of_range("x", -32768, 32767)).collect()] == [False] * 5 + [True] + [False] * 2


def test_audit_sees_added_and_dropped_columns(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", None), (3, "c", 7)], "id int, x string, gone int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", "new"), (4, "d", "new")], "id int, x string, more string")
    log = {r["operacao"] + str(r["dados_antigos"]): r["dados_novos"] for r in audit_diff(old, new, ["id"], "t").collect()}
    assert sorted(k[0] for k in log) == ["D", "I", "U", "U"]
    assert any("gone" in k and '"more"' in (v or "") for k, v in log.items())


def test_stream_restart_with_default_paths(spark, tmpdir_path):
    events = spark.read.parquet(f"{SF_MID}/events.parquet")
    src, log, ck = (f"{tmpdir_path}/{x}" for x in ("events", "log", "ck"))
    cut = events.agg(F.expr("percentile_approx(unix_micros(cast(ts as timestamp)), 0.5)")).first()[0]
    early = F.expr(f"unix_micros(cast(ts as timestamp)) <= {cut}")
    for part in (events.filter(early), events.filter(~early)):
        part.write.mode("append").parquet(src)
        audit_stream(spark, src, log, checkpoint=ck).awaitTermination()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(map(tuple, read_log(spark, log).collect()), key=key) == sorted(
        map(tuple, cdc.audit_events(events).collect()), key=key)
    assert not os.path.exists(f"{ck}-state/v=0") or os.path.exists(f"{ck}-state/v=1")
    events.limit(5).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):  # a lost state fails, it is not taken for an empty one
        audit_stream(spark, src, log, state_path=f"{ck}-lost", checkpoint=ck).awaitTermination()
