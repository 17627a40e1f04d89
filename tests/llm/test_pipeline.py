"""The pipeline, stage by stage on its predecessor's output, against brute force."""

import re

import public_tokenizers
import sentencepiece

import corpus_pipeline
from test_simhash_variants import brute_components, brute_fingerprint
from vigia.llm import pii_surrogates, quality_gbt
from vigia.llm.decontaminate import normal_words

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs, frames = source, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if stage is not corpus_pipeline.tokens:
            assert out.schema == source.schema, name
        frames.append([r.asDict() for r in out.collect()])
        docs = out
    rows = [r.asDict() for r in source.collect()]
    good, unique, clean, private, tokens = frames
    by_id = {r["doc_id"]: r for r in rows}

    forest = quality_gbt.fit(source, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = forest.score(quality_gbt.statistics_matrix([(r["text"] or "").encode() for r in rows]))
    assert {r["doc_id"] for r in good} == {r["doc_id"] for r, s in zip(rows, scores) if s >= 0.3}
    assert all(r == by_id[r["doc_id"]] for r in good + unique + clean)
    assert 0 < len(good) < len(rows)

    ids = [r["doc_id"] for r in good]
    comp = brute_components(ids, [brute_fingerprint(r["text"]) for r in good])
    assert sorted(r["doc_id"] for r in unique) == sorted(set(comp)) and len(unique) < len(good)

    windows = set()
    for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = normal_words((b["text"] or "").encode())
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in windows}

    def leaks(text):
        w = normal_words((text or "").encode())
        return any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in unique if not leaks(r["text"]))
    assert len(clean) < len(unique)

    assert sorted(r["doc_id"] for r in private) == sorted(r["doc_id"] for r in clean)
    entities = {t[a:b] for r in clean for t in [r["text"] or ""] for a, b, _ in pii_surrogates.find_entities(t)}
    assert entities
    for r in private:
        before = by_id[r["doc_id"]]["text"]
        assert not any(e in (r["text"] or "") for e in entities)
        if not pii_surrogates.find_entities(before or ""):
            assert r["text"] == before

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in private}
    assert len(tokens) == len(texts)
    for r in tokens:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["decoded"] == library.decode(r["ids"])


def test_edge_rows_pass_every_stage(spark, tmpdir_path):
    rows = [(1, None, "en", None), (2, "", None, "s"), (3, "word " * 30_000, "en", "s"), (4, "a b c d", "en", "s"),
            (4, "a b c d", "en", "s"), (None, "mail me@x.org now", "en", "s"), (5, "A b c D", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "3L as n_chars", "'x' as contamination", "1 as score", "2 as fp", "'i' as ids")
    df.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(1, "zzz")], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmpdir_path)
        assert docs.schema == df.schema
    out = corpus_pipeline.run(spark, tmpdir_path).collect()
    assert len(out) == 4  # (1, 2), 3, (4, 4, 5) and the one without id
    assert not any(re.search("me@x.org", r["decoded"]) for r in out)
    empty = f"{tmpdir_path}/none"
    df.limit(0).write.parquet(f"{empty}/documents.parquet")
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{tmpdir_path}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
