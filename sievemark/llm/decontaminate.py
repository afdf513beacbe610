"""Benchmark decontamination by pigeonhole edit matching.

A test item of m words may occur with up to k = ``rate * m`` word errors (inserted, lost or
changed words). Cut into k + 1 pieces, at least one piece then occurs unchanged. The cuts are
placed so that each piece holds a run of words that few items share: phrases with which many
items begin are not looked for where the item has rarer words. Exact hits of the runs are
found by hashed word sequences; around each, Myers' bit-parallel edit distance decides. Words
are lower-cased, ASCII punctuation separates.

Items without words match nothing. NULL and empty texts hold nothing. Very long texts are
searched whole. Items travel to the tasks in groups of about ``GROUP_BYTES`` of text. Each
group is one pass over the documents, written to the shared folder before the next begins, so
that a task holds one group at a time and a large benchmark is still searched whole. Repeated
rows get equal results; other columns are carried untouched.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix64, written

RATE = 0.15
GROUP_BYTES = 16_000_000
SIEVE_BITS = 20
LONGEST_PROBE = 5
PUNCTUATION = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
HITS = "array<struct<item_id:bigint,errors:int,start:int,end:int>>"


def words_of(text: str | None, hashes: WordHashes) -> np.ndarray:
    return hashes.of((text or "").lower().encode().translate(PUNCTUATION).split())


def sequences(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    if len(words) < size:
        return words[:0]
    with np.errstate(over="ignore"):
        out = words[: len(words) - size + 1]
        for j in range(1, size):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[j : len(words) - size + 1 + j])
    return out


def rare_runs(common: np.ndarray, size: int, wanted: int) -> list[int]:
    """Starts of ``wanted`` disjoint runs of ``size`` words for which the sum of ``common`` is least.

    ``common`` has a value for each start. Runs in order, one in each of ``wanted`` pieces.
    """
    places = len(common) + size
    costs = [np.zeros(places)]
    for _ in range(wanted):
        cost = np.full(places, np.inf)
        cost[size:] = np.minimum.accumulate(costs[-1][:-size] + common)
        costs.append(cost)
    starts, end = [], places - 1
    for n in range(wanted, 0, -1):
        end = int(np.searchsorted(-costs[n][: end + 1], -costs[n][end])) - size
        starts.append(end)
    return starts[::-1]


def closest(pattern: dict[int, int], m: int, words: list[int]) -> tuple[int, int]:
    """(least edit distance of the pattern to any part of ``words``, where that part ends), by Myers' algorithm.

    ``pattern`` has for each word the bits of its places in the item; integers of m bits.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, w in enumerate(words):
        eq = pattern.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | (full & ~(xh | plus)), plus & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        plus, minus = mh | (full & ~(xv | ph)), ph & xv
        if score < best:
            best, end = score, i + 1
    return best, end


def lacking(pattern: dict[int, int], words: list[int]) -> int:
    """Different words of the pattern that ``words`` lacks: each costs an error."""
    return len(pattern.keys() - set(words))


class Matcher:
    """All items of a group, ready for search."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.hashes = WordHashes()
        self.patterns, self.probes = [], defaultdict(lambda: defaultdict(list))
        by_size = defaultdict(list)
        for item_id, text in items:
            words = words_of(text, self.hashes)
            m = len(words)
            if not m:
                continue
            errors, bits = int(rate * m), defaultdict(int)
            for j, w in enumerate(words.tolist()):
                bits[w] |= 1 << j
            size = min(m // (errors + 1), LONGEST_PROBE)
            by_size[size].append((len(self.patterns), sequences(words, size)))
            self.patterns.append((item_id, m, errors, dict(bits)))
        for size, runs in by_size.items():
            _, which, held = np.unique(np.concatenate([r for _, r in runs]), return_inverse=True, return_counts=True)
            common = np.split(held[which].astype(float), np.cumsum([len(r) for _, r in runs])[:-1])
            for (item, r), shared in zip(runs, common):
                for start in rare_runs(shared, size, self.patterns[item][2] + 1):
                    self.probes[size][int(r[start])].append((item, start))
        self.sieves = {}
        for size, probes in self.probes.items():
            sieve = np.zeros(1 << SIEVE_BITS, bool)
            sieve[np.fromiter(probes, np.uint64, len(probes)) & np.uint64((1 << SIEVE_BITS) - 1)] = True
            self.sieves[size] = sieve

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, errors, start, end) of the best occurrence of each item found, in words of the text."""
        words = words_of(text, self.hashes)
        spots = defaultdict(set)
        for size, probes in self.probes.items():
            runs = sequences(words, size)
            for at in np.flatnonzero(self.sieves[size][runs & np.uint64((1 << SIEVE_BITS) - 1)]).tolist():
                for item, start in probes.get(int(runs[at]), ()):
                    spots[item].add(at - start)
        found = {}
        for item, starts in spots.items():
            item_id, m, errors, bits = self.patterns[item]
            best, low, high = None, None, None
            for s in [*sorted(starts), None]:
                if s is not None and high is not None and s - errors <= high:
                    high = s + m + errors
                    continue
                if high is not None:
                    low = max(low, 0)
                    window = words[low:high].tolist()
                    distance, end = closest(bits, m, window) if lacking(bits, window) <= errors else (m, 0)
                    if distance <= errors and (best is None or distance < best[0]):
                        best = (distance, max(low + end - m, 0), low + end)
                if s is not None:
                    low, high = s - errors, s + m + errors
            if best and (item_id not in found or best[0] < found[item_id][1]):
                found[item_id] = (item_id, *best)
        return sorted(found.values(), key=lambda x: x[0])


def searching(sent: Broadcast, rate: float):
    """Function of a text column: the items of one group that it holds."""

    @F.pandas_udf(HITS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(sent.value, rate)
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "errors", "start", "end"), h)) for h in matcher.search(t)] for t in texts])

    return search


def matched(docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, column: str = "hits") -> DataFrame:
    """``docs`` with an array of (item_id, errors, start, end): the items that the text holds.

    Items with NULL id are not used. Repeated rows count once; of several texts with one id the
    hit with fewest errors is returned.
    """
    spark = docs.sparkSession
    items = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = 1 + size // GROUP_BYTES
    for g in range(groups):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).collect()
        sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in part])
        hits = searching(sent, rate)("text")
        docs = docs.withColumn(column, F.array_sort(F.concat(column, hits)) if g else hits)
        if groups > 1:
            docs = written(docs, f"decontaminate-{g}")
            sent.destroy()
    if groups > 1:  # hits of one id from several groups stand together, the one with fewest errors first
        docs = docs.withColumn(column, F.filter(column, lambda h, i: (i == 0) | (F.get(column, i - 1)["item_id"] != h["item_id"])))
    return docs


def occurrences(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, errors, start, end: one row for each item that a row of ``docs`` holds."""
    marked = matched(docs.select("doc_id", "text"), benchmark, **options)
    return marked.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
