"""Conversation structure repair: the cheapest edits to a well-formed dialogue.

A conversation's rows, by turn, are to read ``(s?(ua)+)?`` by the initials of
their roles: nothing, or an optional system row and then pairs of user and
assistant.  The edits are

* K  keep a row (0);
* R  give a row the role user or assistant (3);
* D  delete a row (4) - blank rows and duplicates must go;
* I  insert an empty user or assistant row (3);

and a truncated row that stays costs 3 more.  Among the cheapest edits those
whose initials are ASCII-least are taken.

Method: a checkpointed dynamic programme over four states (start, after s,
after u, after a).  Going backward, a vector holds the cost from each state to
the end; only the vectors at checkpoints are stored.  Going forward from the
start, the vectors of one block at a time are computed again from its
checkpoint, and of the tight edits (those on a cheapest path) the ASCII-least
is emitted.  A block of n rows stores about sqrt(n) vectors and computes
again sqrt(n) at a time; a conversation of many blocks stores one vector a
block.

In Spark, no task holds a conversation: rows are range-partitioned by
(conversation, turn, role, text hash) and cut into blocks of bounded rows and
bytes, written once with a code byte a row.  A conversation that lies in one
block inside a partition, as most do, is repaired there.  The others are open:
the backward and the forward pass stream over their blocks (code bytes, not
texts) with four numbers of state.  Equal rows that repeat in a conversation are counted before
the rows are dealt, so that copies never meet in one task.

Cases: a null conversation id is a conversation; null turns come first; rows of
equal turn are taken by role, then by the SHA-256 of role and text; of equal
rows of one turn the first counts; null roles and texts count as one space; a
conversation is never dropped, one without rows has zeros and an empty edit
list; a table without rows gives none; an empty role has no initial and fits
nowhere.  Only the named columns are read, others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from .common import record_batch

SPACE = " \t\n\x0b\x0c\r"
KEEP, RETYPE, DELETE, INSERT, MEND = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: Cost from each state when no row is left: what must still be inserted.
END = (0, 2 * INSERT, INSERT, 0)
#: The state after an inserted or retyped row, and the role of that row.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLE_OF = ("user", "user", "assistant", "user")
#: The state after a kept row, by state and initial (s, u, a, other); -1: does not fit.
KEPT = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
#: Adjacent initials that are in order.
IN_ORDER = {(0, 1), (1, 2), (2, 1)}
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)


# -- the dynamic programme ------------------------------------------------------

def back(after: list[int], code: int) -> list[int]:
    """Costs before a row, from the costs after it (code: initial + 4 * fault)."""
    initial, fault = code & 3, code >> 2
    out = [DELETE + x for x in after]
    if fault in (FINE, TRUNCATED):
        more = MEND if fault == TRUNCATED else 0
        for s in range(4):
            retyped = RETYPE + more + after[FOLLOWING[s]]
            if retyped < out[s]:
                out[s] = retyped
            k = KEPT[s][initial]
            if k >= 0 and KEEP + more + after[k] < out[s]:
                out[s] = KEEP + more + after[k]
    return closed(out)


def closed(v: list[int]) -> list[int]:
    """Costs when rows may be inserted first."""
    u, a = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return [min(v[START], INSERT + u), min(v[SYSTEM], INSERT + u), u, a]


def before_copies(after: list[int], copies: int) -> list[int]:
    """Costs before further copies of a row, which must all be deleted."""
    return [DELETE * copies + x for x in after] if copies else after


def backward(codes: bytes, copies: list[int] | None, end: list[int]) -> tuple[list[int], dict[int, list[int]], int]:
    """The costs before the first row, the stored vectors (by row) and their distance."""
    step = max(1, isqrt(len(codes)))
    v, stored = list(end), {len(codes): list(end)}
    for i in range(len(codes) - 1, -1, -1):
        v = back(before_copies(v, copies[i]) if copies else v, codes[i])
        if i % step == 0:
            stored[i] = v
    return v, stored, step


def forward(codes: bytes, copies: list[int] | None, end: list[int], state: int, last: bool) -> tuple[str, int, int]:
    """The ASCII-least cheapest edits of a block entered in ``state``, the state
    after them and their cost.  ``last``: the conversation ends with this block."""
    _, stored, step = backward(codes, copies, end)
    out, spent = [], 0
    for first in range(0, len(codes), step):
        stop = min(first + step, len(codes))
        vectors = [stored[stop]]
        for i in range(stop - 1, first - 1, -1):
            vectors.append(back(before_copies(vectors[-1], copies[i]) if copies else vectors[-1], codes[i]))
        vectors.reverse()
        for i in range(first, stop):
            here, after = vectors[i - first], vectors[i - first + 1]
            further = copies[i] if copies else 0
            after = before_copies(after, further)
            initial, fault = codes[i] & 3, codes[i] >> 2
            more = MEND if fault == TRUNCATED else 0
            while True:
                if DELETE + after[state] == here[state]:
                    out.append("D")
                    spent += DELETE
                elif INSERT + here[FOLLOWING[state]] == here[state]:
                    out.append("I")
                    spent += INSERT
                    state = FOLLOWING[state]
                    continue
                elif KEPT[state][initial] >= 0 and KEEP + more + after[KEPT[state][initial]] == here[state]:
                    out.append("K")
                    spent += KEEP + more
                    state = KEPT[state][initial]
                else:
                    out.append("R")
                    spent += RETYPE + more
                    state = FOLLOWING[state]
                break
            out.append("D" * further)
            spent += DELETE * further
    while last and END[state]:
        out.append("I")
        spent += INSERT
        state = FOLLOWING[state]
    return "".join(out), state, spent


def edited(codes: bytes, copies: list[int] | None, audit: str, state: int) -> Iterator[tuple[int, str | None]]:
    """The rows that edits leave: (row or -1 if inserted, its new role or None if kept)."""
    i, left = 0, 0  # left: copies of row i - 1 still to be deleted
    for edit in audit:
        if edit == "I":
            yield -1, ROLE_OF[state]
            state = FOLLOWING[state]
            continue
        if left:
            left -= 1
            continue
        if edit == "K":
            yield i, None
            state = KEPT[state][codes[i] & 3]
        elif edit == "R":
            yield i, ROLE_OF[state]
            state = FOLLOWING[state]
        left = copies[i] if copies else 0
        i += 1


# -- Spark --------------------------------------------------------------------

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with deterministic faults, chosen by the CRC-32 of
    ``conversation:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    its full stops, 3 repeats it, 4 makes it a user's.  Nulls count as a space."""
    text_of = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)}
    fate = F.crc32(F.concat(text_of[conv], F.lit(":"), text_of[turn])) % 20
    times = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    return rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(text_of[role]).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text_of[text], ".!?", "")).otherwise(text_of[text]).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def _code(role: str, text: str) -> Column:
    """Initial and fault of a row taken alone."""
    first = F.substring(role, 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    seen = F.rtrim(F.col(text), F.lit(SPACE))
    fault = (F.when(seen == "", BLANK).when(F.right(seen, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED))
    return initial + 4 * fault


def _block_schema(conv: T.DataType, turn: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", conv), T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
        T.StructField("codes", T.BinaryType()), T.StructField("copies", T.ArrayType(T.LongType())),
        T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("blank", T.LongType()), T.StructField("duplicate", T.LongType()),
        T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()),
        T.StructField("turns", T.LongType()), T.StructField("first_turn", turn), T.StructField("last_turn", turn),
        T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType())])  # of a block that is a whole conversation


def blocks(rows: DataFrame, most_rows: int = 1024, most_bytes: int = 1 << 20) -> DataFrame:
    """Rows (conv_id, turn, role, text) in blocks of consecutive rows of one
    conversation, numbered (part, seq) in order, written to the shared folder."""
    spark = rows.sparkSession
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("h", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    rows = rows.withColumn("code", _code("role", "text"))
    # Role and text that come back in a conversation, with the first turn (a null turn is first).
    again = reliable_checkpoint(
        rows.filter((F.col("code") / 4).cast("int") != BLANK).groupBy("conv_id", "h")
        .agg(F.count(F.lit(1)).alias("times"), F.min("turn").alias("first"), F.bool_or(F.col("turn").isNull()).alias("null_first"))
        .filter("times > 1").drop("times"), "conversation-repeats")
    again = again.withColumnsRenamed({"conv_id": "again_conv", "h": "again_h"})
    rows = rows.join(again, rows["conv_id"].eqNullSafe(again["again_conv"]) & (rows["h"] == again["again_h"]), "left")
    later = F.when(F.col("null_first"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    rows = rows.withColumn("code", F.when(later, F.col("code") % 4 + 4 * DUPLICATE).otherwise(F.col("code")).cast("int"))
    # Only rows that come back can be many of a kind: count those of one turn.
    once = rows.filter(F.col("again_h").isNull()).withColumn("copies", F.lit(0).cast("long"))
    many = (rows.filter(F.col("again_h").isNotNull()).groupBy("conv_id", "turn", "h")
            .agg(F.first("role").alias("role"), F.first("text").alias("text"), F.first("code").alias("code"),
                 (F.count(F.lit(1)) - 1).alias("copies")))
    columns = ["conv_id", "turn", "role", "text", "h", "code", "copies"]
    rows = once.select(*columns).unionByName(many.select(*columns))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("h").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("h")
    schema = _block_schema(rows.schema["conv_id"].dataType, rows.schema["turn"].dataType)
    return reliable_checkpoint(dealt.mapInArrow(_cut(schema, most_rows, most_bytes), schema), "conversation-blocks")


def _cut(schema: T.StructType, most_rows: int, most_bytes: int):
    def close(conv, part, seq, run, whole):
        turns, roles, texts, codes, copies = run
        faults = [c >> 2 for c in codes]
        initials = [c & 3 for c in codes]
        extra = sum(copies)
        blank = sum(1 + k for f, k in zip(faults, copies, strict=True) if f == BLANK)
        duplicate = sum((f == DUPLICATE) + k for f, k in zip(faults, copies, strict=True) if f != BLANK)
        illegal = extra + sum(pair not in IN_ORDER for pair in zip(initials, initials[1:]))
        known = [t for t in turns if t is not None]
        audit, _, cost = forward(bytes(codes), copies if extra else None, list(END), START, True) if whole else (None, None, None)
        return (conv, part, seq, bytes(codes), copies if extra else None, roles, texts, blank, duplicate,
                sum(f == TRUNCATED for f in faults), illegal,
                len(known[:1]) + sum(a != b for a, b in zip(known, known[1:])),
                known[0] if known else None, known[-1] if known else None, audit, cost)

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        conv, held, size = None, ([], [], [], [], []), 0
        whole = False  # the first conversation may have begun in the partition before
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "code", "copies")]
            for c, *row in zip(*columns, strict=True):
                if held[0] and (c != conv or len(held[0]) >= most_rows or size >= most_bytes):
                    out.append(close(conv, part, seq, held, whole and c != conv))
                    seq, held, size, whole = seq + 1, ([], [], [], [], []), 0, c != conv
                conv = c
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                size += len(row[2])
            if out:
                yield record_batch(schema, [list(x) for x in zip(*out, strict=True)])
        if held[0]:  # the last conversation may go on in the next partition
            yield record_batch(schema, [[x] for x in close(conv, part, seq, held, False)])

    return run


def _checkpoints(cut: DataFrame) -> DataFrame:
    """Each block of the open conversations with the cost vector at its end (backward pass)."""
    columns = ["conv_id", "part", "seq", "codes", "copies", "illegal", "turns", "first_turn", "last_turn"]
    slim = cut.filter(F.col("audit").isNull()).select(*columns)
    schema = T.StructType([*slim.schema.fields, T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("last", T.BooleanType())])
    dealt = slim.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("part").desc(), F.col("seq").desc())

    def run(batches):
        conv, v, any_yet = None, list(END), False
        for batch in batches:
            ends, lasts = [], []
            for c, codes, copies in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "codes", "copies")), strict=True):
                last = not any_yet or c != conv
                conv, any_yet = c, True
                v = list(END) if last else v
                ends.append(v)
                lasts.append(last)
                v = backward(codes, copies, v)[0]
            yield record_batch(schema, [*batch.columns, ends, lasts])

    return dealt.mapInArrow(run, schema)


def walk(cut: DataFrame) -> DataFrame:
    """Each block's edits: the state in which it is entered, the edits' initials
    and their cost, with what adjoining blocks add to the counts.  Blocks that are
    ``whole`` have them already; those of open conversations get them by the
    forward pass."""
    marked = _checkpoints(cut)
    dealt = marked.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "seq")
    schema = T.StructType([
        marked.schema["conv_id"], marked.schema["part"], marked.schema["seq"], T.StructField("state", T.IntegerType()),
        T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType()),
        T.StructField("illegal", T.LongType()), T.StructField("turns", T.LongType())])

    def run(batches):
        conv, state, initial, turn, any_yet = None, START, 3, None, False
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "codes", "copies", "ends", "last", "illegal", "turns", "first_turn", "last_turn"))
            for c, codes, copies, ends, last, illegal, turns, first_turn, last_turn in zip(*columns, strict=True):
                if not any_yet or c != conv:
                    state, turn = START, None
                else:
                    illegal += (initial, codes[0] & 3) not in IN_ORDER
                    turns -= turn is not None and turn == first_turn
                conv, any_yet = c, True
                audit, after, cost = forward(codes, copies, ends, state, last)
                out.append((state, audit, cost, illegal, turns))
                state, initial = after, codes[-1] & 3
                turn = last_turn if last_turn is not None else turn
            kept = [batch.column(c) for c in ("conv_id", "part", "seq")]
            yield record_batch(schema, [*kept, *(list(x) for x in zip(*out, strict=True))] if out else [*kept, *[[]] * 5])

    open_ = reliable_checkpoint(dealt.mapInArrow(run, schema), "conversation-edits")
    whole = cut.filter(F.col("audit").isNotNull()).select(
        "conv_id", "part", "seq", F.lit(START).alias("state"), "audit", "cost", "illegal", "turns")
    return whole.withColumn("whole", F.lit(True)).unionByName(open_.withColumn("whole", F.lit(False)))


def report(conversations: DataFrame, cut: DataFrame, walked: DataFrame) -> DataFrame:
    """One row for each id of ``conversations`` (column conv_id): gaps, faults, the edits and their cost."""
    counts = cut.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"))
    edits = walked.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("illegal", "cost", "turns")],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "seq", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = conversations.select(F.col("conv_id").alias("id")).distinct()
    for side in (counts, edits):
        out = out.join(side, out["id"].eqNullSafe(side["conv_id"]), "left").drop(side["conv_id"])
    gaps = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    return out.select(
        F.col("id").alias("conv_id"), F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"))


def _left(block: dict) -> list[tuple[str, str]]:
    """Role and text of the rows that a block's edits leave."""
    return [(role or block["roles"][i], block["texts"][i] if i >= 0 else "")
            for i, role in edited(block["codes"], block["copies"], block["audit"], block["state"])]


_BLOCK = ["conv_id", "part", "seq", "codes", "copies", "roles", "texts"]


def _whole(cut: DataFrame) -> DataFrame:
    return cut.filter(F.col("audit").isNotNull()).select(*_BLOCK, F.lit(START).alias("state"), "audit")


def _open(cut: DataFrame, walked: DataFrame) -> DataFrame:
    return cut.filter(F.col("audit").isNull()).select(*_BLOCK).join(
        walked.filter(~F.col("whole")).select("part", "seq", "state", "audit"), ["part", "seq"]).select(*_BLOCK, "state", "audit")


def _rows(blocks_: DataFrame) -> DataFrame:
    fields = [blocks_.schema[c] for c in ("conv_id", "part", "seq")]
    schema = T.StructType([*fields, T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            for j in range(batch.num_rows):  # a block is bounded, but for a longer row
                b = batch.slice(j, 1).to_pylist()[0]
                rows = _left(b)
                if rows:
                    n = len(rows)
                    yield record_batch(schema, [[b["conv_id"]] * n, [b["part"]] * n, [b["seq"]] * n, list(range(n)),
                                                [r for r, _ in rows], [t for _, t in rows]])

    return blocks_.mapInArrow(run, schema)


def repaired(cut: DataFrame, walked: DataFrame) -> DataFrame:
    """The rows after the edits: conv_id, (part, seq, place) in order, role, text."""
    return _rows(_whole(cut).unionByName(_open(cut, walked)))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations of rows (conv_id, turn, role, text): the report, one
    row a conversation, and the repaired rows."""
    cut = blocks(rows)
    walked = walk(cut)
    return report(rows, cut, walked), repaired(cut, walked)


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, streamed in order
    (a hash is serial: one task a conversation, whose rows it never holds)."""
    schema = T.StructType([rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    dealt = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "seq", "place")

    def run(batches):
        conv, state = None, None
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text")), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if out:
                yield record_batch(schema, [list(x) for x in zip(*out, strict=True)])
        if state is not None:
            yield record_batch(schema, [[conv], [state.hexdigest()]])

    return dealt.mapInArrow(run, schema)


def _block_digests(whole: DataFrame) -> DataFrame:
    """The digests of conversations that are one block: no row leaves its task."""
    schema = T.StructType([whole.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        for batch in batches:
            found = []
            for j in range(batch.num_rows):
                b = batch.slice(j, 1).to_pylist()[0]
                text = "\n".join(f"{role}:{text}" for role, text in _left(b))
                found.append(hashlib.sha256(text.encode()).hexdigest())
            yield record_batch(schema, [batch.column("conv_id"), found])

    return whole.mapInArrow(run, schema)


def with_digests(found: DataFrame, cut: DataFrame, walked: DataFrame) -> DataFrame:
    """The report with the digest of each conversation's repaired rows."""
    sums = _block_digests(_whole(cut)).unionByName(digests(_rows(_open(cut, walked)))).withColumnRenamed("conv_id", "digest_conv")
    nothing = hashlib.sha256(b"").hexdigest()
    return (found.join(sums, found["conv_id"].eqNullSafe(sums["digest_conv"]), "left").drop("digest_conv")
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(nothing))))
