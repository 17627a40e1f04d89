"""Decontamination: blocks of a large benchmark, span removal, clashing columns."""

from vigia.llm import decontaminate as dc

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"


def frames(spark):
    docs = spark.createDataFrame(
        [(1, f"Start, {ITEM.upper()}! end", "x"), (2, "clean words only", "y"), (3, None, None), (4, "short one", "z"),
         (5, "alpha beta gamma delta epsilon zeta eta theta iota", "w"), (1, f"Start, {ITEM.upper()}! end", "x")],
        "doc_id long, text string, contamination string")
    bench = spark.createDataFrame([(7, ITEM), (8, "Short One"), (8, "Short One"), (9, None), (None, "nowhere to be seen")],
                                  "item_id long, text string")
    return docs, bench


def test_blocks_give_what_one_pass_gives(spark):
    docs, bench = frames(spark)
    one = dc.mark_contamination(docs.drop("contamination"), bench)
    many = dc.mark_contamination(docs.drop("contamination"), bench, block_words=3)
    key = lambda r: (r["doc_id"], str(r))
    assert sorted(one.collect(), key=key) == sorted(many.collect(), key=key)
    found = {r["doc_id"]: r["contamination"] for r in one.collect()}
    assert (found[1]["n_hit"], found[1]["items"], found[1]["n_words"]) == (11, ["7"], 13)
    assert found[4]["items"] == ["8"] and found[5]["n_hit"] == 0 and found[3]["n_words"] == 0


def test_removal_of_documents_and_spans_keeps_all_columns(spark):
    docs, bench = frames(spark)
    kept = dc.decontaminate(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]
    cut = dc.remove_spans(docs, bench)
    assert cut.columns == docs.columns
    texts = sorted(((r["doc_id"], r["text"], r["contamination"]) for r in cut.collect()), key=str)
    assert texts[0] == (1, "Start,           ! end", "x") or texts[0][1].split() == ["Start,", "!", "end"]
    assert {t[1] for t in texts if t[0] == 4} == {" "} and (2, "clean words only", "y") in texts


def test_empty_tables(spark):
    docs, bench = frames(spark)
    assert dc.decontaminate(docs.limit(0), bench).count() == 0
    assert dc.decontaminate(docs, bench.limit(0)).count() == 6
