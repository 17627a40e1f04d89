"""Ranked lexical search: hybrid term-at-a-time / document-at-a-time top-k.

Every item is a bag of query terms, ranked against all documents with integer
weights.  The work is cut into three Spark steps a block of items:

1. ``index``: each task turns runs of documents into inverted lists of the
   block's terms (a bounded vocabulary, by broadcast) and the table of runs is
   written once to the shared checkpoint folder;
2. collection statistics (documents, terms, documents a term) are summed from
   the list lengths in that table;
3. ``search``: each task holds the best ``k`` documents an item and goes
   through its runs.  Lists of few documents are added up term at a time into
   accumulators; the accumulators then are one more iterator, with a bound,
   beside the long lists, which are read document at a time in windows: a
   window whose bounds cannot reach the k-th score so far is skipped, and
   inside a window a document leaves as soon as its score and what the lists
   still to come can add at most stay below it.

The best of all tasks are merged by two ranked aggregations (salted, then by
item).  Skipping only leaves out documents that cannot be among the best, so
the result is exact.

Items are taken in blocks of at most ``block_bytes`` of text (one item at
least); more blocks are more passes, all items are ranked against all rows.

Cases: a null or empty text has no terms and is no document of the collection;
every other row is a document, repeated rows too; equal scores go by ascending
id, a null id last; rows of equal item id are one item with the terms of all
(a null item id is an item); an item without terms, and tables without rows,
give no rows.  Only the named columns are read, others cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from .common import bytes_list, record_batch, text_slices
from .decontaminate import normal_words

#: Constants of the weight: a term's share saturates at SCALE / TF_SCALE.
SCALE, TF_SCALE, LENGTH_SCALE = 1_000_000_000, 1000, 20
LENGTH_BASE, LENGTH_PART = 50, 50


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with n terms (exact integers)."""
    if len(n) and LENGTH_PART * int(n.max()) * n_docs < 2 ** 63:
        return LENGTH_BASE + LENGTH_PART * n * n_docs // n_terms
    return np.array([LENGTH_BASE + LENGTH_PART * int(x) * n_docs // n_terms for x in n], dtype=np.int64)


# -- the index ----------------------------------------------------------------

def _index_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("ids", T.ArrayType(kind)),           # of the run's documents
        T.StructField("n", T.ArrayType(T.LongType())),     # their terms
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("df", T.ArrayType(T.IntegerType())),  # documents in each term's list
        T.StructField("docs", T.BinaryType()),             # the lists, one after the other: places in the run (int32)
        T.StructField("tf", T.BinaryType())])


def index(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text",
          run_docs: int = 2048) -> DataFrame:
    """Inverted lists of the vocabulary's terms, a row for each run of at most
    ``run_docs`` documents."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    slim = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = _index_schema(slim.schema["id"].dataType)

    def emit(run):
        ids, sizes, docs_of, terms_of, tf_of = run
        doc, term, tf = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (docs_of, terms_of, tf_of))
        order = np.lexsort((doc, term))
        doc, term, tf = doc[order], term[order], tf[order]
        names, df = np.unique(term, return_counts=True)
        return record_batch(schema, [[ids], [sizes], [names.astype(np.int32)], [df.astype(np.int32)],
                                     [doc.astype(np.int32).tobytes()], [tf.astype(np.int32).tobytes()]])

    def run_all(batches):
        get = known.value.get
        run, held = ([], [], [], [], []), 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                for i, t in zip(part.column("id").to_pylist(), bytes_list(part.column("text")), strict=True):
                    words = normal_words(t)
                    if not words:
                        continue
                    at = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
                    term, tf = np.unique(at[at >= 0], return_counts=True)
                    run[2].append(np.full(len(term), len(run[0])))
                    run[3].append(term)
                    run[4].append(tf)
                    run[0].append(i)
                    run[1].append(len(words))
                    held += len(term)
                    if len(run[0]) >= run_docs or held >= 1 << 20:
                        yield emit(run)
                        run, held = ([], [], [], [], []), 0
        if run[0]:
            yield emit(run)

    return slim.mapInArrow(run_all, schema)


# -- the search ---------------------------------------------------------------

@dataclass
class Best:
    """The best documents of one item so far, best first."""
    k: int
    rows: list = field(default_factory=list)  # (-score, id is null, id)

    @property
    def least(self) -> int:
        """A document below this score cannot enter."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        new = [(-int(s), i is None, i) for s, i in zip(scores, ids, strict=True)]
        self.rows = sorted(self.rows + new, key=lambda r: r if r[2] is not None else (r[0], True, 0))[: self.k]


class Run:
    """One run of documents, with the score that each list adds."""

    def __init__(self, row: dict, weight: np.ndarray, n_docs: int, n_terms: int, window: int):
        self.ids = row["ids"]
        self.terms = np.asarray(row["terms"], dtype=np.int64)
        self.ends = np.cumsum(np.asarray(row["df"], dtype=np.int64))
        self.docs = np.frombuffer(row["docs"], np.int32)
        tf = np.frombuffer(row["tf"], np.int32).astype(np.int64)
        m = length_factor(np.asarray(row["n"], dtype=np.int64), n_docs, n_terms)
        share = SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m[self.docs])
        self.adds = np.repeat(weight[self.terms], np.diff(self.ends, prepend=0)) * share
        self.window = window
        self.size = -(-len(self.ids) // window) * window
        self.dense: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        order = sorted(range(len(self.ids)), key=lambda d: (self.ids[d] is None, self.ids[d] if self.ids[d] is not None else 0))
        self.by_id = np.empty(len(order), dtype=np.int64)
        self.by_id[order] = np.arange(len(order))

    def span(self, k: int) -> slice:
        return slice(self.ends[k - 1] if k else 0, self.ends[k])

    def long_list(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The list by place in the run, and the most that it adds in each window."""
        if k not in self.dense:
            s, full = self.span(k), np.zeros(self.size, dtype=np.int64)
            full[self.docs[s]] = self.adds[s]
            self.dense[k] = full, full.reshape(-1, self.window).max(axis=1)
        return self.dense[k]

    def search(self, terms: np.ndarray, best: Best, short: int) -> None:
        """Let the documents of this run compete for one item's best."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        lists = at[self.terms[at] == terms]
        if not len(lists):
            return
        length = np.diff(self.ends, prepend=0)[lists]
        # Short lists term at a time: one accumulator array for all of them.
        acc = np.zeros(self.size, dtype=np.int64)
        for k in lists[length <= short]:
            s = self.span(k)
            acc[self.docs[s]] += self.adds[s]
        long = [self.long_list(k) for k in lists[length > short]]
        long.sort(key=lambda x: -int(x[1].max()))
        # The accumulators are one iterator beside the long lists.
        bounds = np.array([acc.reshape(-1, self.window).max(axis=1), *(b for _, b in long)])
        rest = bounds.sum(axis=0)
        live = np.flatnonzero(rest >= best.least)
        if not len(live):
            return
        doc = (live[:, None] * self.window + np.arange(self.window)).ravel()
        score, rest = np.zeros(len(doc), dtype=np.int64), np.repeat(rest[live], self.window)
        for (full, _), bound in zip([(acc, None), *long], bounds, strict=True):
            score = score + full[doc]
            rest = rest - bound[doc // self.window]
            stay = score + rest >= best.least
            if not stay.all():
                doc, score, rest = doc[stay], score[stay], rest[stay]
                if not len(doc):
                    return
        stay = (score >= best.least) & (doc < len(self.ids))
        doc, score = doc[stay], score[stay]
        if len(doc) > best.k:
            first = np.lexsort((self.by_id[doc], -score))[: best.k]
            doc, score = doc[first], score[first]
        best.add(score, [self.ids[d] for d in doc])


def _item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """The items' distinct terms, block by block: (ids, lists of terms)."""
    slim = items.select(F.col(item_id).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    total = slim.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("i"), F.lit(blocks))
    for b in range(blocks):
        found: dict = {}
        for row in slim.filter(part == b).collect():  # at most about block_bytes
            found.setdefault(row["i"], set()).update(normal_words(row["t"].encode()))
        found = {i: sorted(words) for i, words in found.items() if words}
        if found:
            yield list(found), list(found.values())


def _best_of(found: DataFrame, by: list, k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = 2 << 20, run_docs: int = 2048,
           window: int = 128, short_part: int = 16) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    A list of at most ``run_docs / short_part`` documents in a run is short."""
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("item_id", items.schema[item_id].dataType),
                           T.StructField("doc_id", docs.schema[doc_id].dataType),
                           T.StructField("score", T.LongType())])
    found = None
    for ids, words in _item_blocks(items, item_id, item_text, block_bytes):
        vocabulary: dict[bytes, int] = {}
        queries = [np.array(sorted(vocabulary.setdefault(w, len(vocabulary)) for w in ws)) for ws in words]
        lists = reliable_checkpoint(index(docs, vocabulary, doc_id, text, run_docs), "lexical-index")
        sums = lists.select(F.size("ids").cast("long").alias("d"),
                            F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("t")).agg(
            F.sum("d"), F.sum("t")).first()
        if not sums[0]:
            continue
        n_docs, n_terms = int(sums[0]), int(sums[1])
        df = (lists.select(F.explode(F.arrays_zip("terms", "df")).alias("x"))
              .groupBy("x.terms").agg(F.sum("x.df").alias("df")).collect())  # one row a term of the block
        weight = np.zeros(len(vocabulary), dtype=np.int64)
        for row in df:
            weight[row["terms"]] = term_weight(n_docs, int(row["df"]))
        plan = spark.sparkContext.broadcast((ids, queries, weight))
        scanned = lists.mapInArrow(_searcher(plan, n_docs, n_terms, k, window, run_docs // short_part, schema), schema)
        found = scanned if found is None else found.unionByName(scanned)
    if found is None:
        found = spark.createDataFrame([], schema)
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(16)).alias("salt")
    first = _best_of(found.select("*", salt), ["item_id", "salt"], k).drop("rank", "salt")
    return _best_of(first, ["item_id"], k).select("item_id", "rank", "doc_id", "score")


def _searcher(plan, n_docs: int, n_terms: int, k: int, window: int, short: int, schema: T.StructType):
    def run(batches):
        ids, queries, weight = plan.value
        best = [Best(k) for _ in ids]
        for batch in batches:
            for j in range(batch.num_rows):
                part = Run(batch.slice(j, 1).to_pylist()[0], weight, n_docs, n_terms, window)
                if len(part.terms):
                    for terms, b in zip(queries, best, strict=True):
                        part.search(terms, b, short)
        rows = [(i, r[2], -r[0]) for i, b in zip(ids, best, strict=True) for r in b.rows]
        if rows:
            yield record_batch(schema, [list(c) for c in zip(*rows, strict=True)])

    return run
