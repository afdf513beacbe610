"""Suffix-array deduplication: bytes of every repeated string of a given length are removed.

Suffixes are sorted by linear grouping: groups of suffixes with one Lyndon prefix are taken in
descending order, each moves the previous smaller suffixes of its members behind the rest of
their groups, and the finished groups are put in order by one pass over the output. Ranks are
never renamed and nothing is recursive.

One suffix array over a corpus would be one task, so the corpus is cut first, by content. A
window (a string of ``length`` bytes) belongs to its least gram by hash; runs of window starts
with one least gram make a segment. Equal windows have equal grams, so only segments with one
gram hash (a group) can share a window. Segments that are equal as a whole count as one string
with several occurrences, and the distinct strings of a group are suffix-sorted together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bytes whose windows are hashed at once; longer texts are cut into overlapping pieces.
PIECE = 1 << 20
#: Distinct strings of one group are sorted in one task up to this size; larger groups count their windows by hash.
GROUP_BYTES = 2 << 20

_PLACE = np.uint64((1 << 24) - 1)
_MIX, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTES = np.random.default_rng(41).integers(1, 2**63 - 1, 256).astype(np.uint64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (small non-negative integers) in ascending order, in linear time."""
    n = len(text)
    by_symbol = np.argsort(text, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(text[by_symbol]) != 0]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    place, start = np.empty(n, np.int64), np.empty(n, np.int64)
    place[by_symbol], start[by_symbol] = np.arange(n), np.repeat(first, sizes)
    last = np.zeros(n, np.int64)
    last[first] = first + sizes - 1
    order, where, group, last = by_symbol.tolist(), place.tolist(), start.tolist(), last.tolist()
    smaller = [-1] * n  # the previous smaller suffix
    top = n - 1
    while top >= 0:  # groups in descending order; what is moved stays below the group at hand
        low = group[order[top]]
        if low == top:
            s = order[top]
            j = s - 1
            while j >= 0 and group[j] >= low:
                j = smaller[j]
            smaller[s] = j
            if j >= 0:
                old = group[j]
                end = last[old]
                if old != end:
                    at, other = where[j], order[end]
                    order[at], where[other] = other, at
                    order[end], where[j] = j, end
                    last[old] = end - 1
                    group[j] = last[end] = end
            top -= 1
            continue
        followers: dict[int, int] = {}
        for s in sorted(order[low : top + 1]):
            j = s - 1
            while j >= 0 and group[j] >= low:
                j = smaller[j]
            smaller[s] = j
            if j >= 0:
                followers[j] = followers.get(j, 0) + 1
        top = low - 1
        for times in sorted(set(followers.values()), reverse=True):  # more followers: a larger Lyndon prefix
            moved = [j for j, k in followers.items() if k == times]
            leaving: dict[int, int] = {}
            for j in moved:
                old = group[j]
                end, at = last[old], where[j]
                if at != end:
                    other = order[end]
                    order[at], where[other] = other, at
                    order[end], where[j] = j, end
                last[old] = end - 1
                leaving[old] = leaving.get(old, 0) + 1
            for old, k in leaving.items():
                leaving[old] = begin = last[old] + 1
                last[begin] = begin + k - 1
            for j in moved:
                group[j] = leaving[group[j]]
    out, head, done = [-1] * n, list(range(n)), bytearray(n)
    s = n - 1
    for i in range(n):  # a suffix in its final place settles those whose Lyndon prefix ends where it begins
        while s >= 0 and not done[s]:
            g = group[s]
            out[head[g]] = s
            head[g] += 1
            done[s] = 1
            s = smaller[s]
        s = out[i] - 1
    return np.array(out, np.int64)


def blend(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _MIX
    x += b
    x *= _ADD
    x ^= x >> np.uint64(29)
    return x


def ladder(codes: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Hashes of the strings of 1, 2, 4, … bytes from every place, up to ``length``."""
    rungs = {1: _BYTES[codes]}
    size = 1
    while 2 * size <= length:
        rungs[2 * size] = blend(rungs[size][:-size], rungs[size][size:])
        size *= 2
    return rungs


def hashes(rungs: dict[int, np.ndarray], length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from every place: two overlapping rungs."""
    size = 1 << (length.bit_length() - 1)
    h = rungs[size]
    return blend(h[: len(h) - (length - size)], h[length - size :])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, size = len(values) - width + 1, 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def segments(codes: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Segments of the texts that lie one after the other in ``codes``: first and last window
    start, gram hash (key), hash of the whole segment, and place of the gram (-1: tied).

    A window in which several grams share the least hash is tied: it may equal a window of its
    own segment, and no gram can be aligned. Whether it is depends on its bytes alone.
    """
    gram = max(1, length * 8 // 25)
    rungs = ladder(codes, length)
    h = hashes(rungs, gram)
    ranked = (h * _MIX) & ~_PLACE
    places = np.arange(len(h), dtype=np.uint64)
    width = length - gram + 1
    left = (sliding_min(ranked | places, width) & _PLACE).astype(np.int64)
    right = (_PLACE - (sliding_min(ranked | (_PLACE - places), width) & _PLACE)).astype(np.int64)
    starts = np.arange(len(codes) - length + 1)
    inside = starts + length <= np.repeat(ends, np.diff(np.r_[0, ends]))[: len(starts)]
    least = ranked[left]
    tag = np.where(left == right, left, -3 - starts // max(1, length // 2))
    tag[~inside] = -2
    text = np.searchsorted(ends, starts, "right")
    new = (tag[1:] != tag[:-1]) | (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(np.r_[True, new])
    last = np.r_[first[1:], len(starts)] - 1
    kept = inside[first]
    first, last = first[kept], last[kept]
    tied = left[first] != right[first]
    key = np.where(tied, blend(least[first], np.full(len(first), _ADD)), blend(h[left[first]], least[first]))
    size = 1 << (length.bit_length() - 1)
    whole, span = rungs[size], last + length - first
    parts = [whole[first + (span - size) * k // 3] for k in range(4)]
    segment = blend(blend(parts[0], parts[1]), blend(blend(parts[2], parts[3]), span.astype(np.uint64)))
    return {"first": first, "last": last, "key": key.view(np.int64), "seg": segment.view(np.int64), "at": np.where(tied, -1, left[first])}


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Batches of (text number, offset, bytes): every window is whole in just one piece."""
    batch, size = [], 0
    for number, text in enumerate(texts):
        for offset in range(0, max(0, len(text) - length + 1), PIECE):
            part = text[offset : offset + PIECE + length - 1]
            batch.append((number, offset, part))
            size += len(part)
            if size >= PIECE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def cut(length: int):
    """Texts → one row per text with the arrays of its segments."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [bytes(t) for t in frame["text"]]
            found: dict[int, list] = {}
            for batch in pieces(texts, length):
                ends = np.cumsum([len(p) for _, _, p in batch])
                s = segments(np.frombuffer(b"".join(p for _, _, p in batch), np.uint8), ends, length)
                owner = np.searchsorted(ends, s["first"], "right")
                bounds = np.searchsorted(owner, np.arange(len(batch) + 1))
                for i, (number, offset, part) in enumerate(batch):
                    a, z = bounds[i], bounds[i + 1]
                    begin = int(ends[i]) - len(part)
                    first = s["first"][a:z] - begin + offset
                    found.setdefault(number, []).append((
                        s["key"][a:z], s["seg"][a:z], first, s["last"][a:z] - s["first"][a:z],
                        np.where(s["at"][a:z] < 0, -1, s["at"][a:z] - s["first"][a:z]),
                    ))
            if not found:
                continue
            rows = {c: [] for c in ("key", "seg", "first", "more", "at")}
            for number in found:
                for c, arrays in zip(rows, zip(*found[number], strict=True), strict=True):
                    rows[c].append(np.concatenate(arrays))
            numbers = list(found)
            yield pd.DataFrame({"h": frame["h"].to_numpy()[numbers], "size": frame["size"].to_numpy()[numbers], **rows})

    return run


def reach(strings: list[bytes]) -> np.ndarray:
    """How many leading bytes each string shares with the others, at most: with a neighbour in sorted order."""
    width = max(1, *map(len, strings))
    rows = np.array([s.ljust(width, b"\0") for s in strings], f"V{width}")
    matrix = np.frombuffer(rows.tobytes(), np.uint8).reshape(len(strings), width)
    order = np.array(sorted(range(len(strings)), key=strings.__getitem__))
    differ = matrix[order[1:]] != matrix[order[:-1]]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    sizes = np.array([len(s) for s in strings])
    shared = np.minimum(shared, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    out = np.zeros(len(strings), np.int64)
    out[order[1:]] = shared
    out[order[:-1]] = np.maximum(out[order[:-1]], shared)
    return out


def repeated(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, the starts of its windows that occur anywhere else in ``strings``."""
    offsets = np.cumsum([0] + [len(s) + 1 for s in strings])
    text = np.zeros(offsets[-1], np.int64)
    for s, o in zip(strings, offsets, strict=False):
        text[o : o + len(s)] = np.frombuffer(s, np.uint8).astype(np.int64) + 1
    order = suffix_array(text)
    whole = np.zeros(len(text), bool)
    for s, o in zip(strings, offsets, strict=False):
        whole[o : o + max(0, len(s) - length + 1)] = True
    above = np.full(len(text), -1, np.int64)  # the suffix before in sorted order
    above[order[1:]] = order[:-1]
    place = np.flatnonzero(whole)
    place = place[(above[place] >= 0)]
    place = place[whole[above[place]]]
    if len(place):
        rungs = ladder((text.clip(1) - 1).astype(np.uint8), length)
        h = hashes(rungs, length)
        place = place[h[place] == h[above[place]]]
    # Equal hashes are confirmed on bytes: whole windows where a run begins, one byte where it goes on.
    follows = np.zeros(len(place), bool)
    follows[1:] = (place[1:] == place[:-1] + 1) & (above[place[1:]] == above[place[:-1]] + 1)
    equal = text[place + length - 1] == text[above[place] + length - 1]
    for i in np.flatnonzero(~follows):
        a, b = int(place[i]), int(above[place[i]])
        equal[i] = np.array_equal(text[a : a + length], text[b : b + length])
    run = np.cumsum(~follows)
    bad = np.unique(run[~equal])
    good = ~np.isin(run, bad)
    for i in np.flatnonzero(~good):
        a, b = int(place[i]), int(above[place[i]])
        good[i] = np.array_equal(text[a : a + length], text[b : b + length])
    marked = np.zeros(len(text), bool)
    marked[place[good]] = True
    marked[above[place[good]]] = True
    return [np.flatnonzero(marked[o : o + len(s)]) for s, o in zip(strings, offsets, strict=False)]


def runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of consecutive numbers, as (first, last)."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.r_[0, breaks + 1]].tolist(), starts[np.r_[breaks, len(starts) - 1]].tolist(), strict=True))


def sort_groups(length: int):
    """Groups of strings → window runs of the strings that occur once; their repeated windows are found by suffix sorting."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for members in frame["members"]:
                members = list(members)
                texts = [bytes(m["bytes"]) for m in members]
                cuts = np.zeros(len(texts), np.int64)
                if len(texts) > 1 and all(m["at"] >= 0 for m in members):
                    # No repeated window reaches further from the gram than what another string shares with it.
                    ats = np.array([m["at"] for m in members])
                    ahead = reach([t[a:] for t, a in zip(texts, ats, strict=True)])
                    behind = reach([t[:a][::-1] for t, a in zip(texts, ats, strict=True)])
                    cuts = ats - behind
                    texts = [t[c : a + r] for t, c, a, r in zip(texts, cuts, ats, ahead, strict=True)]
                kept = [i for i, t in enumerate(texts) if len(t) >= length]
                if not kept:
                    continue
                for i, starts in zip(kept, repeated([texts[i] for i in kept], length), strict=True):
                    m = members[i]
                    if m["n"] == 1:
                        shift = m["first"] + int(cuts[i])
                        rows += [(m["h"], m["size"], a + shift, z + shift) for a, z in runs(starts)]
            if rows:
                yield pd.DataFrame(rows, columns=["h", "size", "first", "last"])

    return run


def windows(length: int):
    """Strings of groups above the bound → one row per window: its hash and where it starts."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, text, n, h, size, first in zip(*[frame[c] for c in ("key", "bytes", "n", "h", "size", "first")], strict=True):
                hashed = hashes(ladder(np.frombuffer(bytes(text), np.uint8), length), length)
                yield pd.DataFrame({"key": key, "window": hashed.view(np.int64), "n": n, "h": h, "size": size, "first": first + np.arange(len(hashed))})

    return run


def take(length: int):
    """Texts with the segments wanted from them → one row per segment, with its bytes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, h, size, wanted in zip(frame["text"], frame["h"], frame["size"], frame["wanted"], strict=True):
                text = bytes(text)
                for w in wanted:
                    rows.append((w["key"], w["seg"], w["large"], w["n"], h, size, w["first"], w["at"], text[w["first"] : w["last"] + length]))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "seg", "large", "n", "h", "size", "first", "at", "bytes"])

    return run


def identity(text: Column) -> list[Column]:
    """What stands for a text in joins: 64-bit hash and size in bytes; equal texts are one text with several occurrences."""
    return [F.xxhash64(text).alias("h"), F.octet_length(text).alias("size")]


def repeated_starts(texts: DataFrame, length: int, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(h, size, first, last): runs of window starts of a text whose windows start anywhere else too; a run may come twice."""
    arrays = "h long, size int, key array<long>, seg array<long>, first array<int>, more array<int>, at array<int>"
    cut_texts = written(texts.filter(F.col("size") >= length).mapInPandas(cut(length), arrays), "suffix-segments")
    rows = cut_texts.select("h", "size", F.explode(F.arrays_zip("key", "seg", "first", "more", "at")).alias("s")).select(
        "h", "size", "s.key", "s.seg", "s.first", (F.col("s.first") + F.col("s.more")).alias("last"), "s.at"
    )
    groups = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min("seg").alias("one"), F.max("seg").alias("other"), F.min("at").alias("least_at")
    )
    groups = groups.filter((F.col("rows") > 1) | (F.col("least_at") < 0)).select(
        "key", ((F.col("one") != F.col("other")) | (F.col("least_at") < 0)).alias("open")
    )
    # written, so that the join shuffles both sides itself and can split the rows of a frequent key
    groups = written(groups, "suffix-groups")
    shared = written(rows.join(groups, "key"), "suffix-shared")
    run = ["h", "size", "first", "last"]
    # Every segment of such a group is the same string, and there are several.
    closed = shared.filter(~F.col("open")).select(*run)
    # Copies of a text first become one row with their number.
    single = shared.filter("open").groupBy("key", "seg", *run, "at").agg(F.count(F.lit(1)).alias("copies"))
    strings = single.groupBy("key", "seg").agg(
        F.sum("copies").alias("n"), *[F.first(c).alias(c) for c in (*run, "at")]
    )
    strings = written(strings, "suffix-strings")
    several = strings.filter("n > 1").select("key", "seg")
    whole = single.join(several, ["key", "seg"], "left_semi").select(*run)
    bounds = strings.groupBy("key").agg(F.sum(F.col("last") - F.col("first") + length).alias("bytes"), F.min("n").alias("least"))
    wanted = strings.join(written(bounds.filter("least = 1"), "suffix-bounds"), "key").select(
        "h", "size", F.struct("key", "seg", (F.col("bytes") > group_bytes).alias("large"), "n", "first", "last", "at").alias("w")
    )
    wanted = wanted.groupBy("h", "size").agg(F.collect_list("w").alias("wanted"))
    taken = texts.join(wanted, ["h", "size"]).mapInPandas(
        take(length), "key long, seg long, large boolean, n long, h long, size int, first int, at int, bytes binary"
    )
    taken = written(taken, "suffix-strings-bytes").dropDuplicates(["key", "seg"])
    member = F.struct("bytes", "at", "n", "h", "size", "first")
    sorted_runs = (
        taken.filter("not large").groupBy("key").agg(F.collect_list(member).alias("members")).select("members")
        .mapInPandas(sort_groups(length), "h long, size int, first int, last int")
    )
    places = taken.filter("large").select("key", "bytes", "n", "h", "size", "first").mapInPandas(
        windows(length), "key long, window long, n long, h long, size int, first int"
    )
    often = places.groupBy("key", "window").agg(F.sum("n").alias("times")).filter("times > 1").select("key", "window")
    counted = places.filter("n = 1").join(often, ["key", "window"], "left_semi").select("h", "size", "first", F.col("first").alias("last"))
    return closed.union(whole).union(sorted_runs).union(counted)


def removed(length: int):
    @F.pandas_udf("struct<kept: binary, spans: array<struct<start: int, end: int>>>")
    def apply(text: pd.Series, starts: pd.Series) -> pd.DataFrame:
        kept, spans = [], []
        for t, found in zip(text, starts, strict=True):
            if found is None:
                kept.append(None)
                spans.append(None)
                continue
            t, merged = bytes(t), []
            for first, last in sorted((s["first"], s["last"]) for s in found):
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], last + length)
                else:
                    merged.append([first, last + length])
            ends = [0, *[e for _, e in merged]]
            kept.append(b"".join(t[a:b] for a, b in zip(ends, [*[s for s, _ in merged], len(t)], strict=True)))
            spans.append([{"start": s, "end": e} for s, e in merged])
        return pd.DataFrame({"kept": kept, "spans": spans})

    return apply


def remove_repeats(docs: DataFrame, length: int = 400, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, text (bytes), kept (bytes) and spans (start and end of every removed run, in order) of every row.

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else in the
    corpus too, the same text included; strings never cross texts and are judged on the input.
    A NULL text is empty. Rows with one text, NULL or repeated ids included, are occurrences of
    each other. Texts shorter than ``length`` stay whole. An empty table gives no rows.
    Only ``doc_id`` and ``text`` are read. ``length`` is 4 at least.

    Distinct strings of a group above ``group_bytes`` are not sorted in one task: their windows
    are counted by hash over all tasks instead, with the same result. Whole strings that are
    equal in two 64-bit hashes count as equal; windows found by sorting are compared by bytes.
    """
    if length < 4:
        raise ValueError("length is 4 at least")
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", *identity(F.col("text")))
    starts = repeated_starts(rows.select("text", "h", "size"), length, group_bytes)
    found = starts.distinct().groupBy("h", "size").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    joined = rows.join(written(found, "suffix-found"), ["h", "size"], "left")
    hit = F.col("found").isNotNull()
    changed = removed(length)(F.when(hit, F.col("text")), F.col("found"))
    return joined.select("doc_id", "text", "size", hit.alias("hit"), changed.alias("changed")).select(
        "doc_id", "text", F.when(F.col("hit"), F.col("changed.kept")).otherwise(F.col("text")).alias("kept"),
        F.coalesce("changed.spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )
