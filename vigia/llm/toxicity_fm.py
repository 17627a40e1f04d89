"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed terms: its words in lower case, and the
beginnings (4 and 5 bytes) that forms of one word share.  The machine gives each term a
weight and a short vector; a pair of terms adds the product of their vectors,
so that it learns pairs (an insult beside a group) whose weights alone say
little:

    margin = bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

with x_i = 1 for the terms present.  The pair sum is computed in linear time
as half of (sum of vectors)^2 less the sum of squares.  Parameters are learned
on the driver by AdaGrad from a bounded sample of labelled documents: at most
``max_rows`` documents, those of the smallest id hash, and at most
``max_terms`` terms in them.  Parameters go to the terms whose documents'
labels differ from the sample's (a likelihood ratio of ln(terms) at least) and
to the most frequent terms, the context that others may pair with; all other
terms, words never seen among them, add nothing.
Scoring is map-only with the parameters by broadcast (2^bits rows at most, of
which only the learned ones are sent).

Cases: a null or empty text has no terms and gets the score of the bias; a
null label is no label, of several labels for a document the largest counts;
without labels of both classes every score is the share of label 1 (0 without
any); a null doc_id counts as the empty string where documents are dealt to
the held-out part; repeated rows score alike; a table without rows gives none;
a column with the name of a result column is replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_list, record_batch, text_slices
from .decontaminate import normal_words

BITS = 18
#: Bytes of a word that are a term of their own.
BEGINNINGS = (4, 5)


def terms(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """The hashed terms of a text: distinct, ascending."""
    if not text:
        return np.empty(0, dtype=np.int32)
    words = set(normal_words(text.decode().lower().encode()))
    mask = (1 << bits) - 1
    found = {zlib.crc32(w) & mask for w in words}
    for size in BEGINNINGS:
        found.update(zlib.crc32(w, size) & mask for w in {w[:size] for w in words})
    return np.array(sorted(found), dtype=np.int32)


@dataclass
class Machine:
    bias: float
    known: np.ndarray   # learned terms, ascending
    weight: np.ndarray  # (terms,)
    vector: np.ndarray  # (terms, factors)
    bits: int = BITS

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        """Margins of documents given by their hashed terms."""
        size = np.array([len(r) for r in rows], dtype=np.int64)
        flat = np.concatenate([*rows, np.empty(0, np.int32)])
        doc = np.repeat(np.arange(len(rows)), size)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, flat), len(self.known) - 1)
            hit = self.known[at] == flat
            at, doc = at[hit], doc[hit]
        else:
            at, doc = np.empty(0, np.int64), np.empty(0, np.int64)
        linear, total, square = _sums(at, doc, len(rows), self.weight, self.vector)
        return self.bias + linear + 0.5 * ((total ** 2).sum(axis=1) - square)

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -500, 500)))


def _sums(at: np.ndarray, doc: np.ndarray, n: int, w: np.ndarray, v: np.ndarray):
    """By document: sum of weights, sum of vectors, sum of squared vectors."""
    linear = np.bincount(doc, w[at], n)
    total = np.stack([np.bincount(doc, v[at, f], n) for f in range(v.shape[1])], axis=1) if v.shape[1] else np.zeros((n, 0))
    square = np.bincount(doc, (v ** 2).sum(axis=1)[at], n)
    return linear, total, square


def likelihood_ratio(k: np.ndarray, n: np.ndarray, positive: float, total: int) -> np.ndarray:
    """G of terms in n documents, k of them of label 1, against all documents."""
    def log_loss(k, n, p):
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(p) + (n - k) * np.log(1 - p)
    apart = log_loss(k, n, k / n) + log_loss(positive - k, total - n, (positive - k) / np.maximum(total - n, 1))
    return 2 * (apart - log_loss(positive, total, positive / total))


def learned_terms(rows: list[np.ndarray], y: np.ndarray, least_docs: int, context: int) -> np.ndarray:
    """The terms that get parameters, ascending."""
    flat = np.concatenate([*rows, np.empty(0, np.int32)])
    names, inverse, df = np.unique(flat, return_inverse=True, return_counts=True)
    enough = np.flatnonzero(df >= least_docs)
    ratio = likelihood_ratio(np.bincount(inverse, np.repeat(y, [len(r) for r in rows]), len(names))[enough], df[enough],
                             float(y.sum()), len(y))
    telling = enough[ratio >= np.log(max(2, len(enough)))]
    frequent = enough[np.argsort(-df[enough], kind="stable")[: min(context, len(y) // 50)]]
    return names[np.union1d(telling, frequent)]


def fit_machine(rows: list[np.ndarray], y: np.ndarray, factors: int = 8, epochs: int = 12, batch: int = 256,
                rate: float = 0.15, ridge: float = 2e-4, least_docs: int = 3, context: int = 128, seed: int = 1,
                bits: int = BITS) -> Machine:
    """AdaGrad on the log loss, both classes weighing alike."""
    share = float(y.mean()) if len(y) else 0.0
    known = learned_terms(rows, y, least_docs, context) if 0 < share < 1 else np.empty(0, np.int32)
    if not 0 < share < 1 or not len(known):
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Machine(float(np.log(p / (1 - p))), np.empty(0, np.int32), np.empty(0), np.empty((0, factors)), bits)
    slot = np.full(1 << bits, -1, dtype=np.int64)
    slot[known] = np.arange(len(known))
    docs = [s[s >= 0] for s in (slot[r] for r in rows)]
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(known)), rng.normal(0, 0.01, (len(known), factors))
    bias, gb, gw, gv = 0.0, 1e-8, np.full(len(known), 1e-8), np.full(v.shape, 1e-8)
    importance = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for k in range(0, len(order), batch):
            part = order[k: k + batch]
            at = np.concatenate([docs[i] for i in part])
            doc = np.repeat(np.arange(len(part)), [len(docs[i]) for i in part])
            linear, total, square = _sums(at, doc, len(part), w, v)
            margin = bias + linear + 0.5 * ((total ** 2).sum(axis=1) - square)
            g = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y[part]) * importance[part] / len(part)
            gb += g.sum() ** 2
            bias -= rate * g.sum() / np.sqrt(gb)
            if not len(at):
                continue
            used, inverse = np.unique(at, return_inverse=True)
            dw = np.bincount(inverse, g[doc], len(used)) + ridge * w[used]
            # d margin / d v_if = x_i (sum_j v_jf x_j - v_if x_i)
            seen = np.bincount(inverse, g[doc], len(used))
            dv = np.stack([np.bincount(inverse, (g[:, None] * total)[doc, f], len(used)) for f in range(factors)], axis=1)
            dv += (ridge - seen[:, None]) * v[used]
            gw[used] += dw ** 2
            gv[used] += dv ** 2
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= 0.1 * rate * dv / np.sqrt(gv[used])
    return Machine(float(bias), known.astype(np.int32), w, v, bits)


# -- Spark --------------------------------------------------------------------

def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents that no label may be learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8_000, max_terms: int = 6_000_000,
        doc_id: str = "doc_id", text: str = "text", label: str = "toxic", bits: int = BITS, **options) -> Machine:
    """A machine from at most ``max_rows`` labelled documents, with at most
    ``max_terms`` terms, outside the held-out part."""
    sample = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("y"))
              .filter(F.col("y").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
              .groupBy("id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    schema = T.StructType([T.StructField("id", chosen.schema["id"].dataType), T.StructField("y", T.DoubleType()),
                           T.StructField("x", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield record_batch(schema, [part.column("id"), part.column("y"),
                                            [terms(t, bits) for t in bytes_list(part.column("text"))]])

    # A document may come in several rows: still no more than the bounds.
    order = [F.xxhash64("id"), F.col("id"), F.xxhash64("x")]
    rows = chosen.mapInArrow(run, schema).orderBy(*order).limit(max_rows)
    so_far = F.sum(F.size("x").cast("long")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    kept = rows.withColumn("so_far", so_far).filter(F.col("so_far") <= max_terms).select("y", "x").toArrow()
    return fit_machine([np.asarray(x, dtype=np.int32) for x in kept["x"].to_pylist()],
                       kept["y"].to_numpy().astype(np.float64), bits=bits, **options)


def score(docs: DataFrame, machine: Machine, threshold: float = 0.7, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``score`` (0 to 1, higher for label 1) and ``predicted``."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    docs = docs.drop("score", "predicted")
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        m = model.value
        for batch in batches:
            for part in text_slices(batch, text):
                s = m.score([terms(t, m.bits) for t in bytes_list(part.column(text))])
                yield record_batch(schema, [*(part.column(f.name) for f in kept), s, (s >= threshold).astype(np.int32)])

    return docs.mapInArrow(run, schema)
