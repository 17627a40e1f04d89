"""Quality rules with distribution divergence, DataFrame functions only.

Every text gets base counts (words, symbols, repeated lines and three-word
windows) and two histograms: of character classes, and of common function words
with one more bin for all other words.  Summed over all documents of a language
they are that language's references.  A document is kept if the base rules hold
and, where it is long enough to tell (characters for the one, words for the
other), its Jensen-Shannon distance to the reference of its own language is
within a bound for both histograms.

The histograms are written once to the shared checkpoint folder; the references
(one row a language) are written too and joined by their measured size.

Cases: a null or empty text has no words and fails the base rules; a document
below the length guards is judged by the base rules alone, as are a null
language and, for its words, a language without listed function words; every
language of the table has a character reference, so text of any script is held
against its like; repeated rows are judged alike; a table without rows gives
none; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

# Frequent function words of the reference languages.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with", "as", "on", "be", "at", "by",
           "this", "from", "are", "or", "an"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui", "dans", "par",
           "sur", "pas", "avec", "au"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem",
           "nicht", "ein", "eine", "als"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una",
           "su", "al", "lo"),
}
WORD_BINS = tuple(sorted({w for words in COMMON_WORDS.values() for w in words}))
# Character classes as regular expressions; what is left over (lower-case
# letters and control characters) is one more class.  White space is what words
# leave, so it is not searched again.
SPACE_CLASS, SYMBOL_CLASS = "[\\x20\\x09-\\x0D]", "[#*$%&|<>]"
CHAR_CLASSES = ("[A-Z]", "[0-9]", SPACE_CLASS, SYMBOL_CLASS, "[.,;:'\"()?-]", "!", "[^\\x00-\\x7F]")

#: Space characters that may separate words.
_SPACES = "\t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words: runs of anything but space and the control characters 9 to 13."""
    return F.array_remove(F.split(F.regexp_replace(text, "[\\x09-\\x0D]", " "), " "), "")


def _count(text: Column, chars: str) -> Column:
    """Characters of the class in the text: by what is left without its runs
    (no string is made of each match)."""
    return F.length(text) - F.length(F.regexp_replace(text, F.lit(f"{chars}+"), F.lit("")))


def _barrier(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is computed once a row, though later lambdas read it for
    every element."""
    return df.withColumn(name, F.explode(F.array(value)))


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Of each document: id, lang, the base counts and both histograms."""
    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = _barrier(df, "words", words_of(F.col("text")))
    n = F.size("words")
    # Windows of three words by hash, with their places, sorted by hash.
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i"))))
    # A step of its own without lambdas: Spark compiles the sort, which then boxes no key.
    df = _barrier(df, "windows", F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>")))
    df = _barrier(df, "sorted", F.sort_array("windows"))
    twice = F.filter("sorted", lambda x, k: (F.get("sorted", k - 1)["h"] == x["h"]) | F.coalesce(
        F.get("sorted", k + 1)["h"] == x["h"], F.lit(False)))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end")))["n"]
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": _count(F.col("text"), SYMBOL_CLASS).cast("long"),
        "n_repeat_words": covered.cast("long"),
        "codes": _codes(F.col("words")),
    })
    df = _barrier(df, "lines", lines)
    known = {SPACE_CLASS: F.length("text") - F.col("word_chars").cast("int"), SYMBOL_CLASS: F.col("n_symbols").cast("int")}
    classes = [known[c] if c in known else _count(F.col("text"), c) for c in CHAR_CLASSES]
    return df.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.array(*classes, F.length("text")).alias("chars"),
        F.array(*[F.length("codes") - F.length(F.replace("codes", F.lit(_code(k)))) for k in range(len(WORD_BINS))])
        .alias("common"))


def _code(k: int) -> str:
    """A character for the k-th common word."""
    return chr(48 + k)


def _codes(words: Column) -> Column:
    """The common words of a text as a string of one character each."""
    known = F.create_map(*[F.lit(x) for k, w in enumerate(WORD_BINS) for x in (w, _code(k))])
    few = F.filter(words, lambda w: (F.length(w) <= max(map(len, WORD_BINS))) & F.lower(w).isin(*WORD_BINS))
    return F.array_join(F.transform(few, lambda w: F.element_at(known, F.lower(w))), "")


def _total(hist: str) -> Column:
    return F.aggregate(hist, F.lit(0).cast("bigint"), lambda a, x: a + x)


def js_distance(hist: Column, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram's shares to
    reference shares, both arrays of doubles of the same bins."""
    def part(x, y):
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(F.transform(hist, lambda x: x / total), reference, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) / 2, F.lit(0.0)))


def references(counts: DataFrame) -> DataFrame:
    """Of each language (column ref_lang) the shares of both histograms over all
    its documents; no word shares for a language without listed words."""
    sizes = {"chars": len(CHAR_CLASSES) + 1, "common": len(WORD_BINS) + 1}
    sums = counts.filter(F.col("lang").isNotNull()).groupBy("lang").agg(
        *[F.array(*[F.sum(F.get(c, F.lit(k))) for k in range(n)]).alias(c) for c, n in sizes.items()])
    for c in sizes:
        sums = _barrier(sums, f"{c}_total", _total(c))

    def shares(c: str) -> Column:
        return F.when(F.col(f"{c}_total") > 0, F.transform(c, lambda x: x / F.col(f"{c}_total")))

    return sums.select(F.col("lang").alias("ref_lang"), shares("chars").alias("chars_ref"),
                       F.when(F.col("lang").isin(*COMMON_WORDS), shares("common")).alias("common_ref"))


def judge(docs: DataFrame, char_limit: float = 0.32, word_limit: float = 0.33, least_chars: int = 200,
          least_judged: int = 100, least_words: int = 50, repeat_percent: int = 50, **columns) -> DataFrame:
    """Base counts, ``base_failed``, both distances and ``kept``, a row a document."""
    spaced = base_counts(docs, **columns)
    # The last bins are the rest: of the characters, of the words.
    rest = F.get("chars", F.lit(len(CHAR_CLASSES))) - F.aggregate(
        F.slice("chars", 1, len(CHAR_CLASSES)), F.lit(0), lambda a, x: a + x)
    other = F.col("n_words").cast("int") - F.aggregate("common", F.lit(0), lambda a, x: a + x)
    spaced = spaced.withColumns({"chars": F.concat(F.slice("chars", 1, len(CHAR_CLASSES)), F.array(rest)),
                                 "common": F.concat("common", F.array(other))})
    counts = reliable_checkpoint(spaced, "quality-counts")
    known = reliable_checkpoint(references(counts), "quality-references")
    df = counts.join(known, F.col("lang") == F.col("ref_lang"), "left")
    df = _barrier(df, "n_chars", _total("chars"))
    far = {"char_distance": ("chars", F.col("n_chars"), least_chars), "word_distance": ("common", F.col("n_words"), least_judged)}
    df = df.withColumns({
        "base_failed": (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")),
        **{name: F.when((total >= least) & F.col(f"{hist}_ref").isNotNull(), js_distance(F.col(hist), total, F.col(f"{hist}_ref")))
           for name, (hist, total, least) in far.items()}})
    fits = (F.coalesce(F.col("char_distance") <= char_limit, F.lit(True))
            & F.coalesce(F.col("word_distance") <= word_limit, F.lit(True)))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     (~F.col("base_failed") & fits).alias("kept"), "char_distance", "word_distance")
