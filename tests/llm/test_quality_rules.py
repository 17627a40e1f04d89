"""Quality rules: what the distances are for, on texts made for each case."""

import random

from vigia.llm import quality_rules as qr

FILLER = [f"{a}{b}{c}" for a in ("mar", "sol", "ter", "pan", "lig") for b in ("o", "e", "ina") for c in ("t", "nd", "ra", "s")]


def prose(rng, words, n, share=0.4):
    return " ".join(rng.choice(words) if rng.random() < share else rng.choice(FILLER) for _ in range(n))


def judged(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return {r["doc_id"]: r for r in qr.judge(df).collect()}


def corpus():
    rng = random.Random(4)
    rows = [(100 * k + i, prose(rng, qr.COMMON_WORDS[lang], 400), lang) for k, lang in enumerate(("en", "fr", "de", "es")) for i in range(30)]
    cyrillic = [f"{a}{b}" for a in ("при", "вод", "гор", "мор") for b in ("ет", "а", "ний", "ом")]
    rows += [(1000 + i, " ".join(rng.choice(cyrillic) for _ in range(300)) + ".", "ru") for i in range(10)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows += [(2000, " ".join("".join(rng.choices(letters, k=6)) for _ in range(3000)), "en"),
             (2001, " ".join(f"keyword{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)), "de"),
             (2002, " ".join("".join(rng.choices("0123456789$%#", k=8)) for _ in range(500)), "fr"),
             (2003, prose(rng, qr.COMMON_WORDS["en"], 400), None), (2004, prose(rng, qr.COMMON_WORDS["en"], 400), "xx"),
             (2005, " ".join(rng.choices(FILLER, k=70)), "en")]
    return rows


def test_each_text_is_held_against_its_own_language(spark):
    got = judged(spark, corpus())
    assert all(got[100 * k + i]["kept"] for k in range(4) for i in range(30))
    # Clean text of another script, of a language of its own.
    assert all(got[1000 + i]["kept"] and got[1000 + i]["word_distance"] is None for i in range(10))
    # Random words and unique keywords have no function words, whatever their length.
    for i in (2000, 2001):
        assert not got[i]["base_failed"] and not got[i]["kept"] and got[i]["word_distance"] > 0.33
    assert not got[2002]["kept"] and got[2002]["char_distance"] > 0.32
    # A null language has no reference; a language alone is its own.
    assert got[2003]["kept"] and got[2003]["char_distance"] is None
    assert got[2004]["kept"] and got[2004]["char_distance"] == 0 and got[2004]["word_distance"] is None
    # Too short to be judged by its words.
    assert got[2005]["word_distance"] is None and got[2005]["kept"]


def test_distance_is_jensen_shannon(spark):
    import math
    from pyspark.sql import functions as F
    p, q = [3, 0, 5, 2], [0.25, 0.25, 0.5, 0.0]
    df = spark.createDataFrame([(p, q)], "p array<int>, q array<double>")
    got = df.select(qr.js_distance(F.col("p"), F.lit(10), F.col("q"))).first()[0]
    shares = [x / 10 for x in p]
    js = sum((x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0) for x, y in zip(shares, q)) / 2
    assert abs(got - math.sqrt(js)) < 1e-12


def test_classes_are_counted_whatever_the_text(spark):
    import re
    texts = [None, "", "A", "!!!", "AB  \t\n\x0b\x0c\rcd 12#$", "Ünï \U0001F600\U0001F600 é!", "\x00\x1f\x85   x", "-(\"')?.,;:" * 3,
             "$1 \\1 $$", "A" * 20000 + "!" * 20000 + "é" * 20000]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in qr.base_counts(df).collect()}
    for k, t in enumerate(texts):
        assert list(got[k]["chars"]) == [len(re.findall(c, t or "")) for c in qr.CHAR_CLASSES] + [len(t or "")], k
        assert got[k]["n_symbols"] == len(re.findall("[#*$%&|<>]", t or "")), k


def test_windows_are_sorted_compiled_and_rows_not_shuffled(spark, capsys):
    df = spark.createDataFrame(corpus()[:3], "doc_id long, text string, lang string")
    qr.base_counts(df).explain("extended")
    steps = [x for x in capsys.readouterr().out.split("== Physical Plan ==")[1].splitlines() if "Generate" in x and "sort_array(" in x]
    # A lambda beside it would make Spark interpret the sort, two boxed keys a comparison.
    assert steps and not any("lambda" in x for x in steps)
    qr.judge(df).explain("extended")
    assert "RoundRobinPartitioning" not in capsys.readouterr().out
