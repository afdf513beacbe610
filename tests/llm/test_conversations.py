"""Conversation repair against plain versions."""

import hashlib
import random
import re
import zlib

import pytest

import __spark_entry__ as entry
from sievemark.llm import conversations

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def every_edit(heads, faults):
    """(cost, audit, roles) of all edit strings with at most two insertions in a gap: exhaustive."""
    def go(i, roles, cost, audit):
        for inserted in range(3):
            for turn in (("", "u", "a", "ua", "au", "uu", "aa") if inserted == 0 else ()):
                grown, price, said = roles + turn, cost + 2 * len(turn), audit + "I" * len(turn)
                if i == len(heads):
                    if re.fullmatch(r"(s?(ua)+)?", grown):
                        yield price, said, grown
                    continue
                yield from go(i + 1, grown, price + 3, said + "D")
                if faults[i] == 2:
                    continue
                extra = faults[i] == 1
                yield from go(i + 1, grown + (heads[i] or " "), price + extra, said + "K")
                for role in "ua":
                    yield from go(i + 1, grown + role, price + 2 + extra, said + "R")

    return min(go(0, "", 0, ""))


def plain(heads, faults):
    """Least (cost, audit) by carrying whole audits per role of the last row."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    states = {"": (0, "")}

    def grow(found):
        for _ in range(3):
            for s, (c, a) in list(found.items()):
                t = after[s]
                found[t] = min(found.get(t, (1 << 60, "")), (c + 2, a + "I"))
        return found

    for head, fault in zip(heads, faults, strict=True):
        ahead = {}

        def put(t, value):
            ahead[t] = min(ahead.get(t, (1 << 60, "")), value)

        for s, (c, a) in grow(dict(states)).items():
            put(s, (c + 3, a + "D"))
            if fault != 2:
                extra = int(fault == 1)
                if head == after[s] or head == "s" and s == "":
                    put(head, (c + extra, a + "K"))
                put(after[s], (c + 2 + extra, a + "R"))
        states = ahead
    states = grow(dict(states))
    return min(states[s] for s in ("", "a") if s in states)


def test_plain_version_against_all_edits():
    rng = random.Random(1)
    for _ in range(40):
        n = rng.randrange(3)
        heads, faults = [rng.choice("sua ") for _ in range(n)], [rng.randrange(3) for _ in range(n)]
        cost, audit, _ = every_edit(heads, faults)
        assert (cost, audit) == plain(heads, faults)


def solve(kinds):
    vector = conversations.forward(conversations.only(0), kinds, 0, len(kinds))
    end = conversations.crossing(vector, tuple(c for c, _ in conversations.CLOSING))
    return vector[end][0] + conversations.CLOSING[end][0], "".join(conversations.edits(kinds, 0, end)) + conversations.CLOSING[end][1]


def test_halving():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randrange(14)
        heads, faults = [rng.choice("sua ") for _ in range(n)], [rng.choice([0, 0, 1, 2]) for _ in range(n)]
        kinds = bytes(3 * "sua ".index(h) + f for h, f in zip(heads, faults, strict=True))
        assert solve(kinds) == plain(heads, faults)


def test_blocks_in_a_row():
    rng = random.Random(3)
    closing = tuple(c for c, _ in conversations.CLOSING)
    for _ in range(200):
        parts = [bytes(rng.randrange(12) for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 5))]
        sums = [conversations.summary(p) for p in parts]
        ends = conversations.states_between(sums, 0, closing)
        audit = "".join("".join(conversations.edits(p, s, t)) for p, s, t in zip(parts, [0, *ends], ends, strict=False))
        assert audit + conversations.CLOSING[ends[-1]][1] == solve(b"".join(parts))[1]
        top = conversations.joined(sums)
        assert conversations.states_between([top], 0, closing) == ends[-1:]


def brute(rows):
    """The digest columns of every conversation, by plain Python."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        role = "user" if code == 4 else role
        found[conv] += [(turn is not None, turn or 0, role, text[:64], hashlib.md5(text.encode()).hexdigest(), text)] * (2 if code == 3 else 1)
    out = []
    for conv, items in found.items():
        items.sort(key=lambda r: r[:5])
        seen, faults, kinds = set(), [], []
        for *_, role, _, _, text in items:
            if not text.strip(SPACE):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if text.strip(SPACE)[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        heads = [r[2][:1] for r in items]
        cost, audit = plain(heads, [2 if f in ("blank", "duplicate") else int(f == "truncated") for f in faults])
        lines, i, state = [], 0, ""
        for letter in audit:
            turn = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if letter == "K":
                lines.append(f"{items[i][2]}:{items[i][5]}")
                state = items[i][2][:1]
            elif letter in "IR":
                lines.append(f"{turn}:{items[i][5] if letter == 'R' else ''}")
                state = turn[0]
            i += letter != "I"
        turns = {r[1] for r in items if r[0]}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:], strict=False))
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(entry.queries()["op13_conversations"](spark, folder)) == brute(rows)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_edges_and_one_large_conversation(spark, partitions):
    rng = random.Random(5)
    rows = []
    for _ in range(2500):  # one key with most rows, spread over blocks and partitions
        rows.append((7, rng.randrange(900), rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", "é ok! ", f"t{rng.randrange(2000)}."])))
    for conv in [None, 1, 2, 3, (1 << 60) + 1]:
        for _ in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([None, rng.randrange(6)]), rng.choice([None, "", "user", "assistant", "system", "tool"]), rng.choice([None, "", " \t", "Hi.", "hm", "a" * 40000 + "?"])))
    rows += rows[-6:]
    schema = "conv_id long, turn long, role string, text string, part string, block int, cost string"
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert got(conversations.damage_and_repair(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(spark):
    assert conversations.damage_and_repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
