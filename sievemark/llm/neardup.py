"""MinHash near-duplicates with sequential Bayesian verification.

1. Texts with equal shingle sets become one node (its first document stands for it).
2. Nodes that agree on a band of the MinHash signature are candidates. The number of
   bands follows from the threshold and the chosen miss probability.
3. In each bucket the members are compared with one centre, not with each other. A pair
   is compared signature batch by batch; it is dropped once the posterior probability of
   reaching the threshold falls below ``pruned``. Survivors are verified
   on the full shingle sets. Links form components.
4. In buckets that still hold several components, all pairs of members in different
   components are compared, block by block, so that no link between components is left
   out. A block gives one verified link for each two components that it joins.

Words are maximal runs without ASCII white space, A-Z lower-cased. A set holds the
distinct ``shingle``-word shingles as 64-bit hashes; shorter texts are one shingle. NULL, empty and blank texts have
no shingle and no link. Rows whose id is NULL take no part and stay. Rows that repeat an
id count as one document if their sets are linked. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix64, written

SHINGLE, PERCENT = 5, 80
BAND = 4
BATCH = 16
MISS, PRUNED = 1e-6, 1e-9
BLOCK_ITEMS = 400_000
SENT_ROWS = 200_000
SEED = 41
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def band_count(threshold: float, miss: float, band: int = BAND) -> int:
    """Bands so that a pair at the threshold shares none with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**band))


def needed_matches(threshold: float, miss: float, hashes: int, batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes seen, least matches): with fewer, P(similarity >= threshold) < ``miss`` under a uniform prior.

    After m matches of n the posterior is Beta(m + 1, n - m + 1), whose upper tail is that
    of a binomial with n + 1 trials.
    """
    out = []
    for n in [*range(batch, hashes, batch), hashes]:
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def shingle_set(text: str | None, words: WordHashes, shingle: int) -> np.ndarray:
    """Sorted distinct shingles."""
    ids = words.of((text or "").encode().translate(LOWER).split())
    if not len(ids):
        return ids
    size = min(shingle, len(ids))
    with np.errstate(over="ignore"):
        folded = mix64(ids[: len(ids) - size + 1])
        for j in range(1, size):
            folded = mix64(folded * np.uint64(0x9E3779B97F4A7C15) + ids[j : len(ids) - size + 1 + j])
    return np.unique(folded)


class Hasher:
    """MinHash signatures and band keys of shingle sets."""

    def __init__(self, bands: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.bands, self.hashes = bands, bands * BAND
        self.a, self.b = rng.integers(0, 2**63, (2, self.hashes, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.marks = rng.integers(0, 2**63, bands, dtype=np.uint64)

    def signature(self, items: np.ndarray) -> np.ndarray:
        low = np.full(self.hashes, np.iinfo(np.uint64).max, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(0, len(items), 1024):
                np.minimum(low, (self.a * items[i : i + 1024] + self.b).min(axis=1), out=low)
        return (low >> np.uint64(32)).astype(np.uint32)

    def keys(self, signature: np.ndarray) -> np.ndarray:
        halves = signature.reshape(self.bands, BAND).view(np.uint64)
        with np.errstate(over="ignore"):
            return mix64(mix64(halves[:, 0] ^ self.marks) + halves[:, 1]).view(np.int64)


def features(docs: DataFrame, shingle: int, bands: int) -> DataFrame:
    """doc_id, text_hash, n, node (digest of the set), sig, keys; the last three are NULL without shingles."""
    @F.pandas_udf("n long, node binary, sig binary, keys array<long>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words, hasher = WordHashes(), Hasher(bands)
        for texts in batches:
            rows = []
            for text in texts:
                items = shingle_set(text, words, shingle)
                if len(items):
                    sig = hasher.signature(items)
                    rows.append((len(items), hashlib.blake2b(items.tobytes(), digest_size=16).digest(), sig.tobytes(), hasher.keys(sig)))
                else:
                    rows.append((0, None, None, None))
            yield pd.DataFrame(rows, columns=["n", "node", "sig", "keys"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), describe("text").alias("f")).select("doc_id", "text_hash", "f.*")


def plausible(rules: list[tuple[int, int]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of two signature matrices: do they pass each batch of the sequential test?"""
    alive, matches, start = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for n, least in rules:
        matches = matches + (a[alive, start:n] == b[alive, start:n]).sum(axis=1, dtype=np.int32)
        passed = matches >= least
        alive, matches, start = alive[passed], matches[passed], n
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def matrix(signatures: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint32).reshape(len(signatures), -1)


def survivors(pairs: DataFrame, nodes: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """The pairs (a, b) that pass the sequential test."""
    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(plausible(rules, matrix(a), matrix(b)) if len(a) else [], dtype=bool)

    sigs = nodes.select("node", "sig")
    both = (
        pairs.join(sigs.withColumnsRenamed({"node": "b", "sig": "_sb"}), "b")
        .join(sigs.withColumnsRenamed({"node": "a", "sig": "_sa"}), "a")
    )
    return both.filter(passes("_sa", "_sb")).select("a", "b")


def parsed(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, items): full sets of the nodes in ``wanted``, from the text of the document that stands for each.

    The ids are sent to the texts when they are ``SENT_ROWS`` at most; more are joined by shuffle.
    """
    @F.pandas_udf("node binary, items binary")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for texts in batches:
            found = [shingle_set(t, words, shingle) for t in texts]
            yield pd.DataFrame({"node": [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found], "items": [x.tobytes() for x in found]})

    owners = written(nodes.join(wanted, "node").select(F.col("first_id").alias("doc_id"), F.col("node").alias("_node")), "neardup-owners")
    sent = F.broadcast(owners) if owners.count() <= SENT_ROWS else owners
    # written before the filter, which would otherwise move the function below the join
    table = written(docs.select("doc_id", "text").join(sent, "doc_id").select("_node", sets("text").alias("s")), "neardup-sets")
    return table.filter(F.col("s.node") == F.col("_node")).select("s.node", "s.items")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Do two full sets share at least ``percent`` % of their union?"""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def verified(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets, in ``known``, reach the threshold."""
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(a, b)], dtype=bool)

    both = (
        pairs.join(known.withColumnsRenamed({"node": "b", "items": "_ib"}), "b")
        .join(known.withColumnsRenamed({"node": "a", "items": "_ia"}), "a")
    )
    return both.filter(linked("_ia", "_ib")).select("a", "b").distinct()


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates large-star and small-star steps until the edges are stars (every node points to
    one smaller node, which points nowhere); each step is two aggregations and joins over
    written edges, with the minimum combined before the shuffle.
    """
    high = lambda x, y: (F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    current = written(edges.select(*high(F.col("a"), F.col("b"))).filter("u <> v").distinct(), "neardup-edges")
    while True:
        ends = current.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(current.select("v", F.lit(0)))
        if ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("low")).filter("ups > 1 OR (ups > 0 AND low = 0)").isEmpty():
            break
        both = current.union(current.select("v", "u")).toDF("x", "y")
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).filter("u <> v")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        current = written(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "neardup-edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(current.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, band, node, comp, main) for the buckets of three members or more that hold several components.

    ``main`` marks the component with most members. A bucket of two is settled by its centre.
    """
    named = members.filter("size > 2").select("key", "band", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    parts = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("_n"))
    keys = parts.groupBy("key").agg(F.max(F.struct("_n", "comp")).alias("_main"), F.count(F.lit(1)).alias("_comps")).filter("_comps > 1")
    return written(named.join(keys, "key").select("key", "band", "node", "comp", (F.col("comp") == F.col("_main.comp")).alias("main")), "neardup-open")


def block_links(rows: DataFrame, nodes: DataFrame, known: DataFrame, rules: list[tuple[int, int]], percent: int) -> DataFrame:
    """Links (a, b) between the components that meet in a bucket of ``rows``, enough to join them.

    Members outside the main component of a bucket meet all others, in blocks of about
    ``BLOCK_ITEMS`` shingles; each pair of blocks is one bounded group, so a large bucket
    spreads over many tasks and the work follows the members that are not yet linked. Two
    members of the main component are never compared. A group tests size, signature
    and full sets, and gives one link for each two components that it joins.
    """
    width = nodes.select("node", "n")
    sized = rows.join(width, "node")
    blocks = lambda held: F.ceil(F.coalesce(F.sum(F.when(held, F.col("n"))), F.lit(0)) / BLOCK_ITEMS)
    shape = sized.groupBy("key").agg(blocks(~F.col("main")).alias("_o"), blocks(F.col("main")).alias("_m"))
    random = F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("_m")).otherwise(F.col("_o")))
    placed = sized.join(shape, "key").withColumn("own", F.when(F.col("main"), F.col("_o") + random).otherwise(random))
    others = F.sequence(F.lit(0).cast("bigint"), F.when(F.col("main"), F.col("_o")).otherwise(F.col("_o") + F.col("_m")) - 1)
    dealt = (
        placed.withColumn("_other", F.explode(others))
        .select(F.xxhash64("key", F.least("own", "_other"), F.greatest("own", "_other")).alias("g"), "own", "band", "node", "comp")
        .join(nodes.select("node", "sig"), "node").join(known.dropDuplicates(["node"]), "node")
    )
    bands = rules[-1][0] // BAND

    def within(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in groups:
            data = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            cuts = [0, *(np.flatnonzero(np.diff(data["g"].to_numpy())) + 1)]
            for start, end in zip(cuts, cuts[1:]):
                yield from compare(data.iloc[start:end])
            rest = data.iloc[cuts[-1] :]
        if rest is not None and len(rest):
            yield from compare(rest)

    def compare(group: pd.DataFrame) -> Iterator[pd.DataFrame]:
        own, node, sig = group["own"].to_numpy(), group["node"].to_numpy(), matrix(group["sig"])
        band, comp = int(group["band"].iloc[0]), pd.factorize(group["comp"])[0]
        sets = [np.frombuffer(x, np.uint64) for x in group["items"]]
        size, keys = np.array([len(x) for x in sets]), sig.view(np.uint64).reshape(len(sig), bands, -1)
        mixed, links = len(set(own)) > 1, []
        for i in range(len(group) - 1):
            fits = (comp[i + 1 :] != comp[i]) & (100 * np.minimum(size[i], size[i + 1 :]) >= percent * np.maximum(size[i], size[i + 1 :]))
            other = np.flatnonzero(fits & (own[i + 1 :] != own[i]) if mixed else fits) + i + 1
            if not len(other):
                continue
            other = other[plausible(rules, np.broadcast_to(sig[i], (len(other), sig.shape[1])), sig[other])]
            # a pair that shares several buckets is looked at in the first of them
            for j in other[(keys[other] == keys[i]).all(axis=2).argmax(axis=1) == band]:
                if comp[i] != comp[j] and similar(sets[i], sets[j], percent):
                    links.append((min(node[i], node[j]), max(node[i], node[j])))
                    comp[comp == comp[j]] = comp[i]
        if links:
            yield pd.DataFrame(links, columns=["a", "b"])

    return dealt.repartition("g").sortWithinPartitions("g").mapInPandas(within, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, miss: float = MISS, pruned: float = PRUNED) -> DataFrame:
    """doc_id, text_hash, n_shingles, component, component_id, kept for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at least ``percent`` % of the
    union; ``kept`` says that it is the row's own.
    """
    threshold = percent / 100
    bands = band_count(threshold, miss)
    rules = needed_matches(threshold, pruned, bands * BAND)
    rows = written(features(docs, shingle, bands), "neardup-rows")
    nodes = written(
        rows.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull()).groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.max(F.struct("n", "sig", "keys")).alias("f")).select("node", "first_id", "f.*"), "neardup-nodes",
    )
    banded = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(banded.join(shared, "key").select("key", "band", "node", "centre", "size"), "neardup-members")
    pairs = members.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    tested = written(survivors(pairs, nodes, rules), "neardup-survivors")
    known = parsed(ends(tested), nodes, docs, shingle)
    edges = written(verified(tested, known, percent), "neardup-links")
    labels = components(edges)
    left = unsettled(members, labels)
    missing = written(left.select("node").distinct().join(known.select("node"), "node", "left_anti"), "neardup-missing")
    if not missing.isEmpty():
        known = known.union(parsed(missing, nodes, docs, shingle))
    more = written(block_links(left, nodes, known, rules, percent), "neardup-links")
    if not more.isEmpty():
        labels = components(edges.union(more))
    firsts = labels.join(nodes.select("node", "first_id"), "node")
    lowest = firsts.groupBy("comp").agg(F.min("first_id").alias("_lowest"))
    named = (
        nodes.select("node", "first_id").join(labels, "node", "left").join(lowest, "comp", "left")
        .select("node", F.coalesce("_lowest", "first_id").alias("_component"), F.coalesce("comp", "node").alias("_comp"))
    )
    result = rows.select("doc_id", "text_hash", "n", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("_component"))
    return result.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("_comp", "node").alias("component"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
