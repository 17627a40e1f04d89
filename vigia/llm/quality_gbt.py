"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text (shares of character classes, word and line repetition,
lengths) are computed in the tasks.  The trees are grown on the driver from
the statistics of at most ``max_rows`` labelled documents, those of the
smallest id hash: a bounded sample by design.  Features are cut into at most
``bins`` quantile bins; each level of a tree takes its splits from gradient
histograms.  The forest is then flattened into arrays, and scoring walks all
rows through all trees at once.

Cases: a null or empty text has the statistics of no text and gets their
score; a null label is no label, of several labels for a document the smallest
counts; without labels of both classes every score is the share of label 1 (or
0.5 without any); a null doc_id counts as the empty string where documents are
dealt to the held-out part; repeated rows score alike; a table without rows
gives none; a column with the name of a result column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_list, record_batch, text_slices

CLASSES = ("other", "lower", "upper", "digit", "space", "newline", "symbol", "exclamation", "punctuation", "wide")
FEATURES = (*(f"share_{c}" for c in CLASSES), "log_words", "word_length", "distinct_words", "adjacent_repeats",
            "pair_repeats", "repeated_lines", "words_per_line")


def _class_of(c: int) -> int:
    ch = chr(c)
    if c >= 128:
        return 9
    if ch.isalpha():
        return 1 if ch.islower() else 2
    if ch.isdigit():
        return 3
    return {"\n": 5, "!": 7}.get(ch, 4 if ch in " \t\r\x0b\x0c" else 6 if ch in "#*$%&|<>" else 8 if ch.isprintable() else 0)


_CLASS = np.array([_class_of(c) for c in range(256)], dtype=np.uint8)


def statistics(text: bytes | None) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    text = text or b""
    size = max(1, len(text))
    counts = np.zeros(len(CLASSES), dtype=np.int64)
    for k in range(0, len(text), 1 << 20):
        counts += np.bincount(_CLASS[np.frombuffer(text[k: k + (1 << 20)], np.uint8)], minlength=len(CLASSES))
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [*(counts / size).tolist(), float(np.log1p(len(words))), (len(text) - counts[4] - counts[5]) / n,
            len(set(words)) / n, sum(map(eq, words, words[1:])) / n, sum(map(eq, words, words[2:])) / n,
            1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines))]


def statistics_matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


# -- the forest ---------------------------------------------------------------

@dataclass
class Forest:
    """Flat trees.  Node 0.. of each tree lie at ``roots``; a leaf has feature
    -1 and points to itself."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray, rows: int = 4096) -> np.ndarray:
        out = np.empty(len(x))
        for k in range(0, len(x), rows):
            part = x[k: k + rows]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                below = part[row, np.maximum(self.feature[node], 0)] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            out[k: k + rows] = self.base + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
               least: float = 5.0, ridge: float = 1.0) -> Forest:
    """Boosted trees for the log loss, grown level by level from histograms."""
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        share, trees = min(max(share, 1e-6), 1 - 1e-6), 0
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T] if trees else []
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], axis=1) if trees else None
    margin = np.full(len(y), base)

    def add(v: float) -> int:
        n = len(feature)
        feature.append(-1)
        threshold.append(0.0)
        left.append(n)
        right.append(n)
        value.append(v)
        return n

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        root = add(0.0)
        roots.append(root)
        node = np.full(len(y), root)
        level = [root]
        for _ in range(depth):
            slot = np.full(len(feature), -1)
            slot[level] = np.arange(len(level))
            mine = slot[node]
            live = np.flatnonzero(mine >= 0)
            best = [(0.0, -1, 0)] * len(level)
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                key = mine[live] * bins + binned[live, f]
                g = np.bincount(key, grad[live], len(level) * bins).reshape(-1, bins)
                h = np.bincount(key, hess[live], len(level) * bins).reshape(-1, bins)
                c = np.bincount(key, minlength=len(level) * bins).reshape(-1, bins)
                gl, hl, cl = (np.cumsum(a, axis=1)[:, : len(cut)] for a in (g, h, c))
                gt, ht, ct = (a.sum(axis=1, keepdims=True) for a in (g, h, c))
                gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
                gain[(cl < least) | (ct - cl < least)] = 0
                for s in range(len(level)):
                    b = int(gain[s].argmax())
                    if gain[s, b] > best[s][0] + 1e-9:
                        best[s] = (float(gain[s, b]), f, b)
            following = []
            for s, n in enumerate(level):
                gain, f, b = best[s]
                if f < 0:
                    continue
                feature[n], threshold[n] = f, float(cuts[f][b])
                left[n], right[n] = add(0.0), add(0.0)
                inside = live[mine[live] == s]
                node[inside] = np.where(binned[inside, f] <= b, left[n], right[n])
                following += [left[n], right[n]]
            level = following
            if not level:
                break
        g = np.bincount(node, grad, len(feature))
        h = np.bincount(node, hess, len(feature))
        for n in np.unique(node):
            value[n] = float(-rate * g[n] / (h[n] + ridge))
        margin += np.array(value)[node]
    return Forest(base, np.array(roots, dtype=np.int64), np.array(feature, dtype=np.int64), np.array(threshold),
                  np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.array(value), depth)


# -- Spark --------------------------------------------------------------------

def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents that no label may be learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", **options) -> Forest:
    """A forest from at most ``max_rows`` labelled documents outside the
    held-out part."""
    sample = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("y"))
              .filter(F.col("y").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
              .groupBy("id").agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    schema = T.StructType([T.StructField("id", chosen.schema["id"].dataType), T.StructField("y", T.DoubleType()),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield record_batch(schema, [part.column("id"), part.column("y"),
                                            list(statistics_matrix(bytes_list(part.column("text"))))])

    # A document may come in several rows: still no more than the bound.
    rows = (chosen.mapInArrow(run, schema).orderBy(F.xxhash64("id"), "id", "x").limit(max_rows)
            .select("y", "x").toPandas())
    x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit_forest(x, rows["y"].to_numpy(dtype=np.float64), **options)


def score(docs: DataFrame, forest: Forest, threshold: float = 0.3, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``score`` (0 to 1, higher for label 1) and ``predicted``."""
    model = docs.sparkSession.sparkContext.broadcast(forest)
    docs = docs.drop("score", "predicted")
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                s = model.value.score(statistics_matrix(bytes_list(part.column(text))))
                yield record_batch(schema, [*(part.column(f.name) for f in kept), s, (s >= threshold).astype(np.int32)])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").alias("text"))
    marked = score(rows, fit(docs, labels, **options), threshold, "text", keep_text=False)
    return marked.filter("predicted = 1").select("row.*")
