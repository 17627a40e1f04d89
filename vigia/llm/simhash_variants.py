"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has a bit set if over half of the document's shingle hashes have
it.  Two fingerprints are linked if at most ``max_distance`` bits differ.  The
64 bits are cut into ``max_distance // 2 + 1`` segments, so that of two linked
fingerprints one segment differs in at most one bit.  Every distinct
fingerprint is indexed by each segment as it is and by each of the segment's
one-wildcard variants; an equality shuffle brings the holders of a variant
together, where the full distance is checked.

Links leave a task only as the stars of its components, never as all pairs of
a group.  A segment value that more than ``large`` fingerprints share is not
handled by one task as a whole: its buckets are indexed a second time by the
one-wildcard variants of parts of the other bits.

Components come from rounds of large-star and small-star steps on the links,
each written to the shared checkpoint folder.

Cases: a null or empty text has the fingerprint zero and is linked like any
other; equal rows share a component; a null doc_id is never a component's
smallest id unless the component has no other (then it is null); a table
without rows gives none; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from .common import bytes_list, forest, text_slices

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bits set in over half of the 64-bit hashes."""
    votes = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[k: k + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes), bitorder="little").tobytes(), "little")


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words, repeats included."""
    import xxhash
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    stops = ends[size - 1:] if len(words) >= size else ends[-1:]
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), stops.tolist(), strict=True)),
                       dtype=np.uint64, count=n)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """All columns but the text, and ``fp``: the fingerprint as a signed long."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "fp")]
    schema = T.StructType([*kept, T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                fps = [fingerprint_of(shingle_hashes(t, shingle)) for t in bytes_list(part.column(text))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in kept] + [pa.array(np.array(fps, np.uint64).view(np.int64))],
                    names=schema.names)

    return docs.mapInArrow(run, schema)


# -- the index ----------------------------------------------------------------

def segments(max_distance: int, bits: int = 64) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    n = max_distance // 2 + 1
    cuts = [bits * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variant_masks(fields: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(number, kept bits, wildcard bit or -1) of every variant of the fields,
    as masks over the whole fingerprint."""
    out = []
    for shift, width in fields:
        whole = ((1 << width) - 1) << shift
        out.append((len(out), whole, -1))
        for b in range(shift, shift + width):
            out.append((len(out), whole & ~(1 << b), b))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _variants(masks) -> Column:
    """Array of (variant number, kept bits of the fingerprint)."""
    return F.array(*[F.struct(F.lit(v).cast("int").alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long"))
                              .alias("bits")) for v, m, _ in masks])


def _close(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(x[:, None] ^ y[None, :]) <= most


def _sweep(left: np.ndarray, right: np.ndarray, most: int, cells: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs between ``left`` and ``right`` within the
    distance connect: a breadth-first sweep, in which every fingerprint is
    compared once with those not yet reached."""
    same = left is right
    open_right = right.copy()
    open_left = open_right if same else left.copy()
    a, b = [], []
    while len(open_left) and len(open_right):
        front, side = open_left[:1], 0
        open_left = open_left[1:]
        if same:
            open_right = open_left
        while len(front):
            target = open_right if (same or side == 0) else open_left
            reached = np.zeros(len(target), dtype=bool)
            step = max(1, cells // max(1, len(target)))
            for k in range(0, len(front), step):
                rest = np.flatnonzero(~reached)
                if not len(rest):
                    break
                near = _close(front[k: k + step], target[rest], most)
                hit = near.any(axis=0)
                who = near[:, hit].argmax(axis=0)
                a.append(front[k: k + step][who])
                b.append(target[rest[hit]])
                reached[rest[hit]] = True
            front, left_over = target[reached], target[~reached]
            if same:
                open_left = open_right = left_over
            elif side == 0:
                open_right, side = left_over, 1
            else:
                open_left, side = left_over, 0
    return (np.concatenate(a), np.concatenate(b)) if a else (left[:0], left[:0])


def links_within(key: np.ndarray, variant: np.ndarray, fp: np.ndarray, wildcard: np.ndarray, most: int,
                 small: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Star links of the fingerprints that share a (variant, key) bucket.

    ``wildcard`` has the bit that each variant leaves out, or -1.  In a
    wildcard bucket only fingerprints that differ in that bit are of interest:
    the others share the bucket without a wildcard too."""
    order = np.lexsort((fp, key, variant))
    key, variant, fp = key[order], variant[order], fp[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (variant[1:] != variant[:-1])])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(fp)))
    group = np.cumsum(new) - 1
    a, b = [fp[:0]], [fp[:0]]
    in_small = (size <= small)[group]
    for off in range(1, min(small, int(size.max(initial=1)))):
        i = np.flatnonzero(in_small[:-off] & (group[off:] == group[:-off]))
        if not len(i):
            break
        near = np.bitwise_count(fp[i] ^ fp[i + off]) <= most
        a.append(fp[i[near]])
        b.append(fp[i[near] + off])
        if sum(map(len, a)) > 1 << 21:
            a, b = ([x] for x in forest(np.concatenate(a), np.concatenate(b)))
    for g in np.flatnonzero(size > small):
        members = fp[start[g]: start[g] + size[g]]
        bit = int(wildcard[variant[start[g]]])
        if bit < 0:
            x, y = _sweep(members, members, most)
        else:
            has = (members >> np.uint64(bit)) & np.uint64(1) == 1
            x, y = _sweep(members[has], members[~has], most)
        a.append(x)
        b.append(y)
    return forest(np.concatenate(a), np.concatenate(b))


_LINK = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _bucket_links(rows: DataFrame, masks, most: int, keys: list[str]) -> DataFrame:
    """Links within equal ``keys`` of ``rows`` (keys: v, then longs; fp)."""
    wildcard = np.array([w for _, _, w in masks])

    def run(batches):
        held = [pa.Table.from_batches([x]) for x in batches if x.num_rows]
        if not held:
            return
        t = pa.concat_tables(held)
        column = {c: t.column(c).to_numpy() for c in t.column_names}
        key = column[keys[1]].astype(np.int64)
        for c in keys[2:]:  # the first variant's bucket, then the second's
            _, key = np.unique(np.stack([key, column[c].astype(np.int64)]), axis=1, return_inverse=True)
        u, v = links_within(key.ravel(), column[keys[0]], column["fp"].view(np.uint64), wildcard, most)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return rows.repartition(*keys).mapInArrow(run, _LINK)


def links(nodes: DataFrame, max_distance: int = 3, large: int = 16_384) -> DataFrame:
    """Verified links (u, v) between the distinct fingerprints ``nodes.fp`` that
    connect every pair within the distance."""
    fields = segments(max_distance)
    masks = _variant_masks(fields)
    indexed = nodes.select("fp").withColumn("x", F.explode(_variants(masks))).select("fp", "x.v", "x.bits")
    # A bucket holds the fingerprints of one or two values of its segment: only
    # values that many share can make a bucket large.
    whole = [(v, m, w) for v, m, w in masks if w < 0]
    common = (nodes.withColumn("x", F.explode(_variants(whole))).groupBy(F.col("x.bits").alias("bits"), F.col("x.v").alias("v"))
              .count().filter(F.col("count") > large).select(F.col("bits").alias("fp"), "v"))
    own = {v: [k for k, m2, _ in masks if m2 & ~m == 0] for v, m, _ in whole}
    hot_keys = reliable_checkpoint(
        common.withColumn("x", F.explode(_variants(masks)))
        .filter(" or ".join(f"(v = {v} and x.v in ({','.join(map(str, ks))}))" for v, ks in own.items()))
        .select(F.col("x.v").alias("v"), F.col("x.bits").alias("bits")).distinct(), "simhash-hot")
    if not hot_keys.take(1):
        return _bucket_links(indexed, masks, max_distance, ["v", "bits"])
    usual = indexed.join(hot_keys, ["v", "bits"], "left_anti")
    out = _bucket_links(usual, masks, max_distance, ["v", "bits"])
    crowded = indexed.join(hot_keys, ["v", "bits"], "left_semi")
    for shift, width in fields:  # the rest of the bits, cut once more
        inner = [(s + k * w // 2, w // 2 if k == 0 else w - w // 2)
                 for s, w in fields if s != shift for k in (0, 1)]
        if len(fields) == 1:
            continue
        inner_masks = _variant_masks(inner)
        ks = [k for k, m, _ in masks if m & ~(((1 << width) - 1) << shift) == 0]
        rows = (crowded.filter(F.col("v").isin(ks)).withColumn("y", F.explode(_variants(inner_masks)))
                .select(F.col("y.v").alias("w"), "v", "bits", F.col("y.bits").alias("inner"), "fp"))
        out = out.unionByName(_bucket_links(rows, inner_masks, max_distance, ["w", "v", "bits", "inner"]))
    return out


# -- components ---------------------------------------------------------------

def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node
    reachable.  Large-star and small-star rounds until nothing changes."""
    edges = reliable_checkpoint(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = reliable_checkpoint(small, "stars")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components: no end after {most_rounds} rounds")


def link_components(docs: DataFrame, shingle: int = 3, max_distance: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Every document's columns but the text, ``fp``, ``root`` (the component's
    smallest fingerprint) and ``component_id`` (the smallest doc_id that links
    reach); columns of these names are replaced."""
    docs = docs.drop(*(c for c in ("fp", "root", "component_id") if c not in (doc_id, text)))
    marked = reliable_checkpoint(fingerprints(docs, shingle, text), "fingerprints")
    nodes = reliable_checkpoint(marked.groupBy("fp").agg(F.min(doc_id).alias("low")), "nodes")
    roots = components(links(nodes, max_distance))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return marked.join(named.join(lowest, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 3, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One document of each component: the one of the smallest doc_id (of equal
    doc_ids the row of the smallest hash, of equal rows one)."""
    columns = docs.columns
    tagged = docs.withColumn("_row_hash", F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in columns]))
    found = link_components(tagged.select(F.col(doc_id).alias("_id"), "_row_hash", F.col(text).alias("_text")),
                            shingle, max_distance, "_id", "_text")
    kept = tagged.alias("d").join(
        _winners(found), F.col(f"d.{doc_id}").eqNullSafe(F.col("_win_id")) & (F.col("d._row_hash") == F.col("_win_hash")), "inner")
    once = kept.filter("_copies = 1").select(*[F.col(f"d.`{c}`") for c in columns])
    several = kept.filter("_copies > 1").dropDuplicates(["_win_id", "_win_hash"]).select(*[F.col(f"d.`{c}`") for c in columns])
    return once.unionByName(several)


def _winners(found: DataFrame) -> DataFrame:
    """Of each component the row to keep: its id, row hash and number of equal rows."""
    candidates = (found.filter(F.col("_id").eqNullSafe(F.col("component_id")))
                  .groupBy("root", "_id", "_row_hash").agg(F.count(F.lit(1)).alias("n")))
    return (candidates.groupBy("root")
            .agg(F.min(F.struct(F.col("_row_hash").alias("h"), F.col("_id").alias("i"), "n")).alias("k"))
            .select(F.col("k.i").alias("_win_id"), F.col("k.h").alias("_win_hash"), F.col("k.n").alias("_copies")))
