"""Conversation repair: every edit list of small conversations, blocks against
one piece, cases written out, edge rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from vigia.llm import conversation_repair as cr
from vigia.llm import queries as q

WELL = re.compile(r"(s?(ua)+)?")


def all_edits(codes, most_inserts=2):
    """Every edit list of a conversation with its cost: plain enumeration."""
    gaps = list(itertools.product(["", "U", "A", "UA", "AU"][: 1 + 2 * most_inserts], repeat=len(codes) + 1))
    per_row = [["D"] if c >> 2 in (cr.BLANK, cr.DUPLICATE) else ["D", "K", "Ru", "Ra"] for c in codes]
    for rows in itertools.product(*per_row):
        for gap in gaps:
            roles, audit, cost = "", "", 0
            for k in range(len(codes) + 1):
                roles += gap[k].lower()
                audit += "I" * len(gap[k])
                cost += 3 * len(gap[k])
                if k < len(codes):
                    e, c = rows[k], codes[k]
                    audit += e[0]
                    if e == "D":
                        cost += 4
                        continue
                    roles += "suax"[c & 3] if e == "K" else e[1]
                    cost += (0 if e == "K" else 3) + (3 if c >> 2 == cr.TRUNCATED else 0)
            if WELL.fullmatch(roles):
                yield cost, audit, roles


def test_against_every_edit_list():
    rng = random.Random(3)
    for n in (0, 1, 2, 3):
        for _ in range(12 if n < 3 else 6):
            codes = bytes(rng.choice([0, 1, 1, 2, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
            cost, audit, roles = min(all_edits(codes))
            got, state, spent = cr.forward(codes, None, list(cr.END), cr.START, True)
            assert (spent, got) == (cost, audit) and cr.END[state] == 0
            assert cr.backward(codes, None, list(cr.END))[0][cr.START] == cost
            assert "".join((role or "suax"[codes[i] & 3])[0] for i, role in cr.edited(codes, None, got, cr.START)) == roles


def simple(codes):
    """Forward programme over (cost, edits), all vectors in memory."""
    best = {cr.START: (0, "")}

    def insert(b):
        for _ in range(2):
            for s, (c, e) in list(b.items()):
                t = cr.FOLLOWING[s]
                b[t] = min(b.get(t, (1 << 60, "")), (c + 3, e + "I"))
        return b

    insert(best)
    for code in codes:
        new = {}
        for s, (c, e) in best.items():
            steps = [(s, 4, "D")]
            if code >> 2 not in (cr.BLANK, cr.DUPLICATE):
                more = 3 if code >> 2 == cr.TRUNCATED else 0
                steps.append((cr.FOLLOWING[s], 3 + more, "R"))
                if cr.KEPT[s][code & 3] >= 0:
                    steps.append((cr.KEPT[s][code & 3], more, "K"))
            for t, cost, edit in steps:
                new[t] = min(new.get(t, (1 << 60, "")), (c + cost, e + edit))
        best = insert(new)
    return min(best[s] for s in (cr.START, cr.ASSISTANT) if s in best)


def test_checkpoints_and_blocks_change_nothing():
    rng = random.Random(5)
    for n in (1, 7, 40, 90):
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3]) + 4 * rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n))
        want = simple(codes)
        got, _, spent = cr.forward(codes, None, list(cr.END), cr.START, True)
        assert (spent, got) == want
        cuts = sorted(rng.sample(range(1, n), min(3, n - 1)))
        pieces = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
        ends = [list(cr.END)]
        for p in reversed(pieces[1:]):
            ends.insert(0, cr.backward(p, None, ends[0])[0])
        state, audit, cost = cr.START, "", 0
        for k, (p, end) in enumerate(zip(pieces, ends)):
            a, state, c = cr.forward(p, None, end, state, k == len(pieces) - 1)
            audit, cost = audit + a, cost + c
        assert (cost, audit) == want


def test_copies_are_rows():
    codes, copies = bytes([1, 2, 1]), [2, 0, 1]
    plain = bytes([1, 1 + 4 * cr.DUPLICATE, 1 + 4 * cr.DUPLICATE, 2, 1, 1 + 4 * cr.DUPLICATE])
    assert cr.forward(codes, copies, list(cr.END), cr.START, True) == cr.forward(plain, None, list(cr.END), cr.START, True)
    audit = cr.forward(codes, copies, list(cr.END), cr.START, True)[0]
    assert [i for i, _ in cr.edited(codes, copies, audit, cr.START)] == [0, 1, 2, -1]


def by_hand(rows):
    """The contract on one conversation's rows after damage, with lists."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    turns = {t for t, _, _ in rows if t is not None}
    faults, seen = [], set()
    for _, role, text in rows:
        words = text.strip(cr.SPACE)
        faults.append(cr.BLANK if not words else cr.DUPLICATE if (role, text) in seen else cr.FINE if words[-1] in ".!?" else cr.TRUNCATED)
        seen.add((role, text))
    codes = bytes({"s": 0, "u": 1, "a": 2}.get(r[1][:1], 3) + 4 * f for r, f in zip(rows, faults))
    cost, audit = simple(codes)
    lines = [f"{role or rows[i][1]}:{rows[i][2] if i >= 0 else ''}" for i, role in cr.edited(codes, None, audit, cr.START)]
    pairs = [(a & 3, b & 3) for a, b in zip(codes, codes[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(cr.BLANK), faults.count(cr.DUPLICATE),
            faults.count(cr.TRUNCATED), sum(p not in cr.IN_ORDER for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged_by_hand(rows):
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(fate, 1)):
            yield c, (t, role, text)


def expected(rows):
    groups = {c: [] for c, *_ in rows}
    for c, row in damaged_by_hand(rows):
        groups[c].append(row)
    return {c: by_hand(g) for c, g in groups.items()}


def made_rows(seed, conversations=40):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.choice([0, 1, 3, 9, 30])):
            rows.append((c, rng.choice([t, t, t, t // 2, None, -t]), rng.choice(["user", "assistant", "assistant", "system", "tool", "", None, "ütil"]),
                         rng.choice(["Hello.", "And so?", "cut off", " \n\t", "", None, "Same!", "x. \r\n", "no ", f"t{t}."])))
    rows += [(None, 0, "user", "a."), (None, None, "assistant", "b."), (7, 2, "user", "Same!"), (7, 2, "user", "Same!"), (7, 2, "user", "Same!")]
    rows += [(1000, t % 3, "user", "over and over.") for t in range(300)]  # one hot conversation of copies
    rows += [(1001, t, ["user", "assistant"][t % 2], "w" * 50_000 + ("." if t % 5 else "")) for t in range(40)]
    return rows


@pytest.mark.parametrize("most_rows", [2, 1024])
def test_against_lists(spark, most_rows):
    rows = made_rows(11)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    cut = cr.blocks(cr.damage(table), most_rows=most_rows)
    walked = cr.walk(cut)
    out = cr.with_digests(cr.report(table, cut, walked), cut, walked).collect()
    got = {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                          r["repaired_sha256"]) for r in out}
    assert len(out) == len(got) and got == expected(rows)
    assert max(cut.selectExpr("max(length(codes))").first()) <= most_rows
    # Conversations of one block inside a partition are repaired there, the others by the two passes: the same rows.
    assert 0 < cut.filter("audit is not null").count() < cut.count()
    lines = {}
    for r in cr.repaired(cut, walked).orderBy("part", "seq", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == v[-1] for c, v in got.items())


def test_query_edge_cases(spark, tmpdir_path):
    spark.createDataFrame([(5, 0, "user", "?", 1)], "conv_id long, turn long, role string, text string, copies int").limit(0).write.parquet(
        f"{tmpdir_path}/none/conversations.parquet")
    assert q.op11_conversation_repair(spark, f"{tmpdir_path}/none").collect() == []
    # Every row of the conversation is dropped; columns of clashing names do no harm.
    gone = [(c, 0) for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    spark.createDataFrame([(c, t, "user", "a.", "x", 3, "y") for c, t in gone],
                          "conv_id long, turn long, role string, text string, codes string, part int, audit string").write.parquet(
        f"{tmpdir_path}/conversations.parquet")
    out = q.op11_conversation_repair(spark, tmpdir_path).collect()
    assert sorted(r["conv_id"] for r in out) == [c for c, _ in gone]
    assert all((r["gaps"], r["cost"], r["audit"]) == (0, 0, "") and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in out)


def test_repair_gives_rows(spark):
    rows = spark.createDataFrame([(1, 0, "system", "Hi."), (1, 1, "assistant", "So."), (1, 2, "user", "End"), (1, 3, "tool", "Yes!")],
                                 "conv_id long, turn long, role string, text string")
    report, fixed = cr.repair(rows)
    r = report.first()
    assert (r["audit"], r["cost"], r["truncated"], r["illegal"]) == ("KIKKR", 9, 1, 2)
    assert [(x["role"], x["text"]) for x in fixed.orderBy("part", "seq", "place").collect()] == [
        ("system", "Hi."), ("user", ""), ("assistant", "So."), ("user", "End"), ("assistant", "Yes!")]
