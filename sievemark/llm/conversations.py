"""Conversation structure repair: cheapest edits that give a conversation the roles ``(s?(ua)+)?``.

A conversation is a path through four states (nothing yet, after system, after user, after
assistant). Every row is one edit, insertions may stand between rows, and of the cheapest
edit strings the ASCII-least one is wanted. Rows are cut into bounded blocks. A block is summed
up by the costs between its entry and exit states, with the order of the edit strings; forward
and backward cost vectors over the blocks of a conversation meet at every block border, the
audit-least optimal crossing fixes the state there, and each block is then solved alone by
halving (Hirschberg), with two cost vectors as memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .common import written

#: Rows and characters of text in one block at most (a single longer text is a block of its own);
#: a batch of blocks stays small enough for one worker.
BLOCK_ROWS, BLOCK_CHARS = 1024, 1 << 15
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
KEEP, REROLE, DELETE, INSERT, UNMENDED = 0, 2, 3, 2, 1
#: State after an inserted or re-roled turn: user, but assistant after user.
TURN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
FAR = 1 << 60
Cell = tuple[int, str]


def best(cells: list[Cell | None]) -> Cell | None:
    return min((c for c in cells if c is not None), default=None)


@cache
def step(kind: int) -> tuple[tuple[Cell | None, ...], ...]:
    """Cheapest (cost, edits) over one row from state to state; kind = 3 * role (s, u, a, other) + fault.

    Fault 0 is none, 1 truncated, 2 to be deleted. Insertions stand before the row's edit.
    """
    role, fault = divmod(kind, 3)
    table: list[list[Cell | None]] = [[None] * 4 for _ in STATES]
    for s in STATES:
        table[s][s] = (DELETE, "D")
        if fault == 2:
            continue
        at, waste = s, UNMENDED * fault
        for inserted in range(3):
            letters, cost = "I" * inserted, INSERT * inserted + waste
            allowed = {0: SYSTEM if at == NOTHING else None, 1: USER if TURN[at] == USER else None, 2: ASSISTANT if TURN[at] == ASSISTANT else None}
            if allowed.get(role) is not None:
                table[s][allowed[role]] = best([table[s][allowed[role]], (cost + KEEP, letters + "K")])
            table[s][TURN[at]] = best([table[s][TURN[at]], (cost + REROLE, letters + "R")])
            at = TURN[at]
    return tuple(map(tuple, table))


#: What closes a conversation after its last row, by state.
CLOSING: tuple[Cell, ...] = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
Vector = tuple[tuple[int, int], ...]  # by state: cost, rank of its edit string among the four


@cache
def ordered(kind: int) -> tuple[tuple[tuple[int, int], ...], ...]:
    """``step`` with edits replaced by their rank among the exits of one entry."""
    out = []
    for row in step(kind):
        order = sorted(t for t in STATES if row[t] is not None)
        order.sort(key=lambda t: row[t][1])
        out.append(tuple((row[t][0], order.index(t)) if row[t] is not None else (FAR, 0) for t in STATES))
    return tuple(out)


def extend(vector: Vector, costs: tuple[tuple[tuple[int, int], ...], ...]) -> Vector:
    """Forward vector after one more row or block: cost first, then the order of the edit strings."""
    found = []
    for t in STATES:
        found.append(min((vector[s][0] + costs[s][t][0], vector[s][1], costs[s][t][1]) for s in STATES))
    order = sorted(STATES, key=lambda t: (found[t][0] >= FAR, found[t][1:]))
    return tuple((min(found[t][0], FAR), order.index(t)) for t in STATES)


def before(costs: tuple[tuple[tuple[int, int], ...], ...], vector: tuple[int, ...]) -> tuple[int, ...]:
    """Backward costs before a row or block, from those behind it."""
    return tuple(min(FAR, min(costs[s][t][0] + vector[t] for t in STATES)) for s in STATES)


_moves: dict[tuple[Vector, int], tuple[int, Vector]] = {}
_turns: dict[tuple[tuple[int, ...], int], tuple[int, tuple[int, ...]]] = {}


def forward(vector: Vector, kinds: bytes, low: int, high: int) -> Vector:
    """Vector behind rows low to high; vectors less their least cost are few, so steps are looked up."""
    total = 0
    for kind in kinds[low:high]:
        known = _moves.get((vector, kind))
        if known is None:
            ahead = extend(vector, ordered(kind))
            least = min(c for c, _ in ahead)
            known = _moves[vector, kind] = least, tuple((c - least if c < FAR else FAR, r) for c, r in ahead)
        total += known[0]
        vector = known[1]
    return tuple((c + total if c < FAR else FAR, r) for c, r in vector)


def backward(kinds: bytes, low: int, high: int, vector: tuple[int, ...]) -> tuple[int, ...]:
    total = 0
    for kind in reversed(kinds[low:high]):
        known = _turns.get((vector, kind))
        if known is None:
            back = before(ordered(kind), vector)
            least = min(back)
            known = _turns[vector, kind] = least, tuple(c - least if c < FAR else FAR for c in back)
        total += known[0]
        vector = known[1]
    return tuple(c + total if c < FAR else FAR for c in vector)


def only(state: int) -> Vector:
    return tuple((0 if s == state else FAR, 0 if s == state else 1 + s) for s in STATES)


def crossing(ahead: Vector, behind: tuple[int, ...]) -> int:
    """The optimal state to meet in whose edits so far are ASCII-least."""
    return min(STATES, key=lambda s: (ahead[s][0] + behind[s], ahead[s][1]))


def edits(kinds: bytes, entry: int, leave: int) -> list[str]:
    """Edit string of every row of a block from state ``entry`` to ``leave``, by halving."""
    out = [""] * len(kinds)
    todo = [(0, len(kinds), entry, leave)]
    while todo:
        low, high, s, t = todo.pop()
        if high - low == 1:
            out[low] = step(kinds[low])[s][t][1]
        elif high > low:
            middle = (low + high) // 2
            behind = backward(kinds, middle, high, tuple(0 if x == t else FAR for x in STATES))
            meet = crossing(forward(only(s), kinds, low, middle), behind)
            todo += [(low, middle, s, meet), (middle, high, meet, t)]
    return out


def summary(kinds: bytes) -> list[int]:
    """Costs and ranks of a block, entry by entry: 32 numbers."""
    return [x for s in STATES for pair in forward(only(s), kinds, 0, len(kinds)) for x in pair]


def unpacked(numbers) -> tuple[tuple[tuple[int, int], ...], ...]:
    n = [int(x) for x in numbers]
    return tuple(tuple((n[8 * s + 2 * t], n[8 * s + 2 * t + 1]) for t in STATES) for s in STATES)


def joined(sums: list[list[int]]) -> list[int]:
    """Summary of blocks in a row."""
    tables = [unpacked(x) for x in sums]
    out = []
    for s in STATES:
        vector = only(s)
        for t in tables:
            vector = extend(vector, t)
        out += [x for pair in vector for x in pair]
    return out


def states_between(sums: list[list[int]], entry: int, behind: tuple[int, ...]) -> list[int]:
    """State at every border of blocks in a row, the last included; ``behind``: costs after them, by state."""
    tables = [unpacked(x) for x in sums]
    backs = [behind]
    for t in reversed(tables[1:]):
        backs.append(before(t, backs[-1]))
    vector, out = only(entry), []
    for t, back in zip(tables, reversed(backs), strict=True):
        vector = extend(vector, t)
        out.append(crossing(vector, back))
    return out


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage by crc32(``conv_id:turn``) modulo 20; NULLs are one space. Columns conv_id, turn, role, text, copies."""
    space = F.lit(" ")
    code = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code")).filter("code <> 0").select(
        "conv_id", "turn", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("code") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def faulty(rows: DataFrame) -> DataFrame:
    """Runs of equal rows of one turn, with their number and the first fault of the first of them.

    ``fault`` is 0 none, 1 truncated, 2 duplicate, 3 blank; the further rows of a run are
    duplicates, or blank with the first.
    """
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    keyed = equal.withColumn("hash", F.md5("text"))
    # Where a role and text come first; only what comes in several turns has to be looked up.
    first = keyed.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("hash").alias("_hash")).agg(
        F.count(F.lit(1)).alias("_turns"), F.min("turn").alias("_first"), F.count_if(F.col("turn").isNull()).alias("_null"),
    ).filter("_turns > 1")
    first = written(first, "conversation-repeats")
    known = keyed.join(first, same("conv_id", "_conv") & (F.col("role") == F.col("_role")) & (F.col("hash") == F.col("_hash")), "left")
    again = F.when(F.col("_null") > 0, F.col("turn").isNotNull()).otherwise(F.coalesce(F.col("turn") > F.col("_first"), F.lit(False)))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), 3).when(again, 2).when(~last.isin(".", "!", "?"), 1).otherwise(0)
    return known.select("conv_id", "turn", "role", "text", "hash", "copies", fault.alias("fault"))


BLOCK = "conv_id string, part int, block int, n long, kinds binary, roles array<string>, texts array<string>, copies array<long>, sums array<long>, blank long, duplicate long, truncated long, illegal long, head string, tail string"


def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows → blocks of one conversation each, in order, with their summaries."""
    held: list[tuple] = []
    state = {"conv": None, "part": 0, "block": 0, "chars": 0}

    def flush() -> list[tuple]:
        if not held:
            return []
        roles, texts, copies, faults = map(list, zip(*held, strict=True))
        kinds = bytes(3 * {"s": 0, "u": 1, "a": 2}.get(r[:1], 3) + min(f, 2) for r, f in zip(roles, faults, strict=True))
        heads = [r[:1] for r in roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:], strict=False)) + sum(copies) - len(copies)
        row = (
            state["conv"], state["part"], state["block"], sum(copies), kinds, roles, texts, copies, summary(kinds),
            sum(c for c, f in zip(copies, faults, strict=True) if f == 3),
            sum(c - (f != 2) for c, f in zip(copies, faults, strict=True) if f != 3), sum(f == 1 for f in faults), illegal, heads[0], heads[-1],
        )
        held.clear()
        state["block"] += 1
        state["chars"] = 0
        return [row]

    for frame in frames:
        rows = []
        for conv, part, role, text, copies, fault in zip(*[frame[c] for c in ("conv_id", "part", "role", "text", "copies", "fault")], strict=True):
            if held and (conv != state["conv"] or len(held) >= BLOCK_ROWS or state["chars"] + len(text) > BLOCK_CHARS):
                rows += flush()
            if conv != state["conv"]:
                state["block"] = 0
            state["conv"], state["part"] = conv, part
            state["chars"] += len(text)
            held.append((role, text, int(copies), int(fault)))
        if rows:
            yield pd.DataFrame(rows, columns=COLUMNS)
    if held:
        yield pd.DataFrame(flush(), columns=COLUMNS)


COLUMNS = [c.split()[0] for c in BLOCK.split(", ")]


@F.pandas_udf(ArrayType(LongType()))
def join_sums(sums: pd.Series) -> pd.Series:
    return pd.Series([joined(list(x)) for x in sums])


@F.pandas_udf(ArrayType(IntegerType()))
def between(sums: pd.Series, entry: pd.Series, leave: pd.Series) -> pd.Series:
    """Borders of blocks; leave is the wanted last state, or -1 for the end of a conversation."""
    out = []
    for x, s, t in zip(sums, entry, leave, strict=True):
        behind = tuple(c for c, _ in CLOSING) if t < 0 else tuple(0 if z == t else FAR for z in STATES)
        out.append(states_between(list(x), int(s), behind))
    return pd.Series(out)


@F.pandas_udf(StructType().add("audit", StringType()).add("lines", StringType()).add("cost", LongType()))
def solved(kinds: pd.Series, roles: pd.Series, texts: pd.Series, copies: pd.Series, entry: pd.Series, leave: pd.Series, final: pd.Series) -> pd.DataFrame:
    """Edits of a block, the repaired lines of what it keeps, and their cost."""
    out = []
    for k, r, t, c, s, z, end in zip(kinds, roles, texts, copies, entry, leave, final, strict=True):
        k, state, letters, lines, cost = bytes(k), int(s), [], [], 0
        for i, edit in enumerate(edits(k, int(s), int(z))):
            for letter in edit:
                if letter in "IR":
                    state = TURN[state]
                    lines.append(("user:" if state == USER else "assistant:") + ("" if letter == "I" else t[i]))
                elif letter == "K":
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[r[i][:1]]
                    lines.append(f"{r[i]}:{t[i]}")
            if k[i] % 3 == 1 and edit[-1] != "D":
                cost += UNMENDED
            letters.append(edit + "D" * int(c[i] - 1))
        for letter in CLOSING[state][1] if end else "":
            state = TURN[state]
            lines.append("user:" if state == USER else "assistant:")
            letters.append(letter)
        audit = "".join(letters)
        cost += INSERT * audit.count("I") + REROLE * audit.count("R") + DELETE * audit.count("D")
        out.append((audit, "\n".join(lines) if lines else None, cost))
    return pd.DataFrame(out, columns=["audit", "lines", "cost"])


def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines in order of conversation and block → sha256 of each conversation, one block in memory at a time."""
    conv, running, begun = None, None, False
    for frame in frames:
        rows = []
        for c, lines in zip(frame["conv_id"], frame["lines"], strict=True):
            if running is None or c != conv:
                if running is not None:
                    rows.append((conv, running.hexdigest()))
                conv, running, begun = c, hashlib.sha256(), False
            if lines is not None:
                running.update(("\n" if begun else "").encode() + lines.encode())
                begun = True
        if rows:
            yield pd.DataFrame(rows, columns=["conv_id", "repaired_sha256"])
    if running is not None:
        yield pd.DataFrame([(conv, running.hexdigest())], columns=["conv_id", "repaired_sha256"])



def repaired_blocks(rows: DataFrame) -> DataFrame:
    """One row per block of a conversation: conv_id (as a string), part, block, faults, borders, audit, repaired lines and cost.

    ``rows`` has conv_id, turn, role, text and copies. Rows of a conversation are taken by turn,
    NULL first; rows of one turn by role, then by the first 64 characters of the text, then by
    its md5; equal rows are adjacent.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "prefix", "hash")]
    ranged = faulty(rows).withColumn("prefix", F.substring("text", 1, 64)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    cut = ranged.select(
        F.col("conv_id").cast("string").alias("conv_id"), F.spark_partition_id().alias("part"), "role", "text", "copies", "fault"
    ).mapInPandas(blocks, BLOCK)
    cut = written(cut, "conversation-blocks")
    # Blocks of one part of a conversation are bounded by the partition, parts by the number of partitions.
    piece = F.array_sort(F.collect_list(F.struct("block", "sums")))
    parts = cut.groupBy("conv_id", "part").agg(piece.alias("b"))
    parts = written(parts.select("conv_id", "part", F.col("b.block").alias("numbers"), F.col("b.sums").alias("own")), "conversation-parts")
    tops = parts.select("conv_id", "part", join_sums("own").alias("sums")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "sums"))).alias("p"))
    tops = tops.select("conv_id", F.col("p.part").alias("numbers"), between("p.sums", F.lit(0), F.lit(-1)).alias("ends"))

    def spread(df: DataFrame, number: str, *also: Column) -> DataFrame:
        """Entry, exit and whether it is the last, of every element."""
        size = F.size("numbers")
        each = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
            F.element_at("numbers", i + 1).alias(number),
            F.when(i == 0, F.col("entry")).otherwise(F.element_at("ends", F.greatest(i, F.lit(1)))).alias("entry"),
            F.element_at("ends", i + 1).alias("leave"), (F.col("final") & (i == size - 1)).alias("final"),
        ))
        return df.select("conv_id", *also, F.explode(each).alias("e")).select("conv_id", *also, "e.*")

    tops = spread(tops.withColumns({"entry": F.lit(0), "final": F.lit(True)}), "part")
    tops = tops.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "entry", "leave", "final")
    inner = parts.join(tops, same("conv_id", "_conv") & (F.col("part") == F.col("_part")))
    inner = inner.select("conv_id", "part", "numbers", "entry", "final", between("own", "entry", "leave").alias("ends"))
    ends = spread(inner, "block", F.col("part"))
    ends = ends.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("block").alias("_block"), "entry", "leave", "final")
    placed = cut.join(ends, same("conv_id", "_conv") & (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block")))
    result = solved("kinds", "roles", "texts", "copies", F.col("entry"), F.col("leave"), F.col("final"))
    counts = ["n", "blank", "duplicate", "truncated", "illegal", "head", "tail"]
    return placed.select("conv_id", "part", "block", *counts, result.alias("s")).select("conv_id", "part", "block", *counts, "s.*")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation that has rows: faults counted, cost, audit and sha256 of the repaired text.

    ``rows`` as in ``repaired_blocks``. Roles other than system, user and assistant by their first
    letter are deleted or re-roled. Blank rows and rows whose role and text came earlier are
    always deleted. Conversations of any size are spread over blocks; only the digest of one that
    spans several blocks is taken in one task, block after block, since sha256 is sequential.
    """
    done = written(repaired_blocks(rows), "conversation-repaired")
    # Rows next to each other across a border of blocks.
    within = Window.partitionBy("conv_id").orderBy("part", "block")
    pair = F.concat(F.lag("tail").over(within), F.col("head"))
    edges = done.select("conv_id", "part", "block", "head", "tail").withColumn("edge", F.when(pair.isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0))
    edges = edges.groupBy("conv_id").agg(F.sum("edge").alias("edges"))
    total = done.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.count(F.lit(1)).alias("blocks"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "block", "audit"))), lambda b: b["audit"]), "").alias("audit"),
        F.first("lines", ignorenulls=True).alias("lines"),
    )
    total = total.join(edges.withColumnRenamed("conv_id", "_conv"), same("conv_id", "_conv"))
    several = total.filter("blocks > 1").select(F.col("conv_id").alias("_several"))
    lines = done.join(several, same("conv_id", "_several"), "left_semi").select("conv_id", "part", "block", "lines")
    streamed = lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").select("conv_id", "lines").mapInPandas(
        digests, "conv_id string, repaired_sha256 string"
    ).select(F.col("conv_id").alias("_streamed"), "repaired_sha256")
    return total.join(streamed, same("conv_id", "_streamed"), "left").select(
        F.col("conv_id").cast(rows.schema["conv_id"].dataType).alias("conv_id"), "blank", "duplicate", "truncated", (F.col("illegal") + F.col("edges")).alias("illegal"), "cost", "audit",
        F.coalesce("repaired_sha256", F.sha2(F.coalesce(F.col("lines"), F.lit("")).cast("binary"), 256)).alias("repaired_sha256"),
    )


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """Every conv_id of ``conversations`` with what damage did and what repair costs.

    A conversation that damage leaves without rows has zeros, an empty audit and the digest of
    the empty string. NULL is a conv_id of its own. An empty table gives no rows. ``gaps`` is
    the number of turns missing between the least and the greatest. Further columns are not read.
    """
    rows = damaged(conversations)
    fixed = written(repair(rows), "conversation-results").withColumnRenamed("conv_id", "_conv")
    turns = rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    ).withColumnRenamed("conv_id", "_turns")
    every = conversations.select("conv_id").distinct()
    result = every.join(fixed, same("conv_id", "_conv"), "left").join(turns, same("conv_id", "_turns"), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return result.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
