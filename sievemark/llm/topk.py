"""Exact top-k by inner product with a dual-tree search over cover trees.

Candidates and queries are dealt into bounded blocks; each pair of blocks is one task
group. In it both sides get a cover tree: children lie within their parent's cover
radius, centres of one level are further apart than that of their children, and a parent is
its own first child. Pairs of nodes are visited together; for nodes with centres q, c and
radii r, s no product exceeds ``q.c + r|c| + s|q| + r s``, and a pair is left when that is
below the worst k-th score of the queries under the query node. Block results are merged
by Spark. Ranks follow exact integer products of any size; ties go to the smaller id. Products
that doubles hold exactly are taken in doubles, in blocks with larger components in Python
integers. Components beyond a long take its nearest end, and so does a returned score.

Vectors that are NULL or hold NULL or non-finite components, and rows without id, take no
part. Vectors of different length are not compared. Rows that repeat id and vector count
once; an id with several vectors takes a place for each of them, as query and as candidate.
A query never meets its own id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256
LEAF = 24
COVER = 0.6
CANDIDATE_BLOCK, QUERY_BLOCK = 6000, 1500
STEP = 2048


class CoverTree:
    """Nodes in arrays: centre, radius over all points below, children or the points of a leaf."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.norms = np.sqrt((self.points**2).sum(axis=1))
        self.centre, self.radius, self.below, self.children = [], [], [], []
        if len(points):
            self.grow(np.arange(len(points)), 0)
        self.centre, self.radius = np.array(self.centre, int), np.array(self.radius)

    def distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        gap = self.points[rows] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def grow(self, rows: np.ndarray, centre: int) -> int:
        far = self.distances(rows, centre)
        node = len(self.centre)
        radius = float(far.max())
        self.centre.append(centre)
        self.radius.append(radius * (1 + 1e-9))
        self.below.append(rows)
        self.children.append(None)
        if len(rows) > LEAF and radius > 0:
            cover, parts, left, at = radius * COVER, [], rows, centre
            while len(left):
                near = self.distances(left, at) <= cover
                parts.append((left[near], at))
                left = left[~near]
                at = int(left[0]) if len(left) else at
            lone = [p for p, _ in parts if len(p) <= 2]
            kept = [self.grow(p, c) for p, c in parts if len(p) > 2]
            if lone:  # points that cover next to nothing share leaves, cut at random
                spare = np.concatenate(lone)
                for i in range(0, len(spare), LEAF):
                    kept.append(self.leaf(spare[i : i + LEAF]))
            self.children[node] = np.array(kept, int)
        return node

    def leaf(self, rows: np.ndarray) -> int:
        self.centre.append(int(rows[0]))
        self.radius.append(float(self.distances(rows, int(rows[0])).max()) * (1 + 1e-9))
        self.below.append(rows)
        self.children.append(None)
        return len(self.centre) - 1


def search(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, k) scores and rows of ``points``, best first; rows are -1 where there are fewer. ``ids`` must ascend.

    Scores are Python integers where products may leave the exact range of doubles.
    """
    q, c = CoverTree(queries), CoverTree(points)
    size = max(1, len(points))
    most = 0
    if len(queries) and len(points):
        most = max(1, queries.shape[1]) * max(-int(queries.min()), int(queries.max())) * max(-int(points.min()), int(points.max()))
    exact = most < 1 << 53 and (most + 1) * size < 1 << 62
    none = np.iinfo(np.int64).min if exact else -(1 << 200)
    wide_q, wide_c = (queries, points) if exact else (queries.astype(object), points.astype(object))
    # score * size - row: ties prefer the smaller row
    best = np.full((len(queries), k), none, np.int64 if exact else object)

    def scan(rows: np.ndarray, columns: np.ndarray) -> None:
        if exact:
            products = np.rint(q.points[rows] @ c.points[columns].T).astype(np.int64)
        else:
            products = wide_q[rows] @ wide_c[columns].T
        keys = products * size - columns
        keys[query_ids[rows][:, None] == ids[columns]] = none
        both = np.concatenate([best[rows], keys], axis=1)
        best[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:] if exact else np.sort(both, axis=1)[:, -k:]

    def worst(rows: np.ndarray) -> float:
        low = int(best[rows].min())
        return -float("inf") if low == none else float(-((-low) // size))

    def visit(node: int, others: np.ndarray) -> None:
        rows, centre, radius = q.below[node], q.centre[node], q.radius[node]

        def bounds(nodes: np.ndarray) -> np.ndarray:
            at, s = c.centre[nodes], c.radius[nodes]
            reach = radius * c.norms[at] + s * q.norms[centre] + radius * s
            # what rounding may have taken from the product and from the k-th score
            slack = 1e-6 + 1e-9 * (reach + c.norms[at] * q.norms[centre])
            return c.points[at] @ q.points[centre] + reach + slack

        final = q.children[node] is None
        while len(others):
            limit = bounds(others)
            alive = limit >= worst(rows)
            others, limit = others[alive], limit[alive]
            inner = np.array([c.children[o] is not None for o in others], bool)
            if not inner.any():
                break
            others = np.concatenate([others[~inner], *[c.children[o] for o in others[inner]]])
        if not len(others):
            return
        if not final:
            order = q.children[node]
            for child in order:
                visit(child, others)
            return
        others = others[np.argsort(-limit, kind="stable")]
        limit = np.sort(limit)[::-1]
        start = 0
        while start < len(others) and limit[start] >= worst(rows):
            end, total = start, 0
            while end < len(others) and total < STEP:
                total += len(c.below[others[end]])
                end += 1
            scan(rows, np.concatenate([c.below[o] for o in others[start:end]]))
            start = end

    if len(points) and len(queries):
        visit(0, np.array([0]))
    keys = np.sort(best, axis=1)[:, ::-1]
    missing = keys == none
    scores = np.where(missing, 0, -((-keys) // size))
    return scores, np.where(missing, -1, scores * size - keys).astype(np.int64)


LIMB = 62


def limbs(scores: np.ndarray) -> dict[str, np.ndarray]:
    """Integers of any size as three longs that sort like them."""
    mask = (1 << LIMB) - 1
    parts = {"high": [int(s) >> 2 * LIMB for s in scores], "mid": [int(s) >> LIMB & mask for s in scores], "low": [int(s) & mask for s in scores]}
    return {name: np.array(values, np.int64) for name, values in parts.items()}


def integer_vector(vector: Column) -> Column:
    """floor(SCALE * x) of each component as double, or NULL if a component is NULL or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(~F.exists(vector, bad), F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for each query row, against all rows of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), integer_vector(F.col("embedding")).alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).dropDuplicates(["vec_id", "v"])
    total = rows.agg(F.count(F.lit(1)), F.count_if("q")).first()
    c_blocks, q_blocks = 1 + total[0] // CANDIDATE_BLOCK, 1 + total[1] // QUERY_BLOCK
    spread = F.xxhash64("vec_id", "v")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    candidates = rows.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(spread, F.lit(c_blocks)).alias("cb"), every(q_blocks).alias("qb"))
    asked = rows.filter("q").select("vec_id", "v", F.size("v").alias("dim"), F.pmod(spread, F.lit(q_blocks)).alias("qb"), every(c_blocks).alias("cb"))

    def block(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "high": [], "mid": [], "low": []}).astype("int64")
        b = b.sort_values("vec_id", kind="stable")
        ids, asked_ids = b["vec_id"].to_numpy(), a["vec_id"].to_numpy()
        scores, found = search(np.stack(a["v"].to_numpy()), asked_ids, np.stack(b["v"].to_numpy()), ids, k)
        there = found >= 0
        return pd.DataFrame({"query_id": np.repeat(asked_ids, there.sum(axis=1)), "vec_id": ids[found[there]], **limbs(scores[there])})

    keys = ["dim", "cb", "qb"]
    found = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(block, "query_id long, vec_id long, high long, mid long, low long")
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("mid"), F.desc("low"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    # high and mid of a long are 0 and 0 or 1, or -1 and the two largest
    whole = F.when((F.col("high") == 0) & (F.col("mid") <= 1), F.shiftleft("mid", LIMB) + F.col("low")).when(
        (F.col("high") == -1) & (F.col("mid") >= (1 << LIMB) - 2), F.shiftleft(F.col("mid") - (1 << LIMB), LIMB) + F.col("low")
    )
    ends = F.when(F.col("high") >= 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-(1 << 63)))
    return ranked.select("query_id", "rank", "vec_id", F.coalesce(whole, ends).alias("score"))
