"""Repair of conversations against a search over all edits."""

import binascii
import hashlib
import random
import re

import pytest

from placepulse.llm import conversations as c

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, audit STRING, _same INT"


def search(rows):
    """Least ``(cost, audit, repaired rows)`` over all edits: rows are ``(role, text, fault)``."""
    best = [(4 * len(rows), "D" * len(rows), [])]

    def go(i, cost, audit, out, inserted):
        if cost > best[0][0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
            best[0] = min(best[0], (cost, audit, out))
        if inserted < 3:
            for role in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*out, (role, "")], inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", out, 0)
            if fault in "-t":
                more = 3 * (fault == "t")
                go(i + 1, cost + more, audit + "K", [*out, (role, text)], 0)
                for other in ("user", "assistant"):
                    go(i + 1, cost + 3 + more, audit + "R", [*out, (other, text)], 0)

    go(0, 0, "", [], 0)
    return best[0]


def expected(turns, ids=()):
    """The whole report, row by row."""
    groups = {i: [] for i in ids}
    for conv, turn, role, text in turns:
        role, text = (" " if v is None else v for v in (role, text))
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role, hash_of(conv, role, text), turn, text))
    report = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: r[:4])
        seen, faults = set(), []
        for _, _, role, _, _, text in rows:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "-"
            seen.add((role, text))
            faults.append((role, text, fault))
        named = [r[4] for r in rows if r[4] is not None]
        gaps = max(named) - min(named) + 1 - len(set(named)) if named else 0
        initials = [r[2][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = search(faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        counts = [sum(f[2] == k for f in faults) for k in "bdt"]
        report.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(report, key=repr)


def hash_of(conv, role, text):
    return hashlib.sha256(f"{'-' if conv is None else conv}:{len(role)}:{role}{text}".encode()).hexdigest()


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", 1) for t in turns], TURNS)


def got(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(11)
    turns = []
    for conv in range(60):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!", "And", " \t", "", None, "é?\n", "a. ", "." * 40])
            turns.append((conv if conv else None, rng.choice([turn, turn, turn * 3, None, 2]), role, text))
    return turns


def test_repair_is_the_search(spark, odd):
    ids = spark.createDataFrame([(3,), (999,), (None,)], "conv_id BIGINT")
    want = expected(odd, [999])
    assert got(c.repair_report(frame(spark, odd), ids)) == want
    # Partitions that cut conversations.
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        assert got(c.repair_report(frame(spark, odd), ids)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got(c.repair_report(frame(spark, []))) == []


def test_blocks_multiply_to_the_whole():
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 40):
        for _ in range(30):
            rows = "".join(rng.choice("suaa-") + rng.choice("---tbd") for _ in range(n))
            cut = 2 * rng.randint(0, n)
            halves = c.multiply(c.block(rows[:cut]), c.block(rows[cut:]))
            assert c.finished(halves) == c.finished(c.block(rows)) == c.repair(rows)
            packed = c._unpacked(c._packed(halves))
            assert c.finished(packed) == c.repair(rows)


def test_long_conversation_over_many_tasks(spark):
    turns = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(3000)] + [(1, 5000, "user", "Turn 7.")]
    [row] = got(c.repair_report(frame(spark, turns)))
    assert row[1] == 2000 and row[2:7] == (0, 0, 0, 0, 3) and row[7] == "K" * 3001 + "I"
    turns[1500] = (1, 1500, "assistant", "Turn 1.")
    [row] = got(c.repair_report(frame(spark, turns)))
    assert row[3] == 1 and row[6] == 4 + 3 + 3 and len(row[7]) in (3002, 3003)


def test_damage(spark):
    turns = [(i, t, "system", "A. b! c?") for i in range(40) for t in range(4)] + [(None, None, None, None)]
    want = []
    for conv, turn, role, text in turns:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind, role, text = binascii.crc32(key.encode()) % 20, role or " ", text or " "
        row = {1: (conv, turn, role, ""), 2: (conv, turn, role, re.sub("[.!?]", "", text)), 4: (conv, turn, "user", text)}
        want += [row.get(kind, (conv, turn, role, text))] * {0: 0, 3: 2}.get(kind, 1)
    damaged = c.damaged(frame(spark, turns))
    assert sorted(map(repr, map(tuple, damaged.collect()))) == sorted(map(repr, want))


def test_repaired_turns(spark, odd):
    rows = [r.asDict() for r in c.repaired_turns(frame(spark, odd)).collect()]
    groups = {}
    for r in sorted(rows, key=lambda r: r["turn"]):
        groups.setdefault(r["conv_id"], []).append(r)
    digests = {k: hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in v).encode()).hexdigest() for k, v in groups.items()}
    for conv, *_, digest in expected(odd):
        assert digests.get(conv, hashlib.sha256(b"").hexdigest()) == digest
    assert all([r["turn"] for r in v] == list(range(len(v))) for v in groups.values())
