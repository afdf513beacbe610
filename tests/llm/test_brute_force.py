"""Operators without SQL against plain Python versions, and what the models learn on rows they have not seen."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest

from sievemark.llm import decontaminate, langid, neardup, queries, topk, toxicity
from sievemark.llm.common import WordHashes

FOLDER = "/root/testdata/sf0.001"


def sets(texts, k):
    out = {}
    for i, t in texts.items():
        w = [x.decode() for x in (t or "").encode().translate(neardup.LOWER).split()]
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def classes(found, percent):
    """Smallest id of each component, over all pairs that share a shingle."""
    parent = {i: i for i in found}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i in sorted(found):
        shared = Counter(j for s in found[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(found[i]) + len(found[j]) - n):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
        for s in found[i]:
            holders[s].append(i)
    return {i: top(i) for i in found}


def copies(seed, n_base=30, groups=(40, 12, 3)):
    """Random texts with groups of near copies that form chains: each is an edit of an earlier one."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [[rng.choice(words) for _ in range(rng.randint(1, 90))] for _ in range(n_base)]
    for size in groups:
        chain = [[rng.choice(words) for _ in range(80)]]
        for _ in range(size):
            copy = list(rng.choice(chain))
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            chain.append(copy)
        texts += chain
    rng.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("shingle,percent", [(3, 85), (5, 80)])
def test_neardup_finds_all_links(spark, monkeypatch, shingle, percent):
    monkeypatch.setattr(neardup, "BLOCK_ITEMS", 400)  # a few texts a block, so that buckets are split
    texts = copies(7)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, shingle=shingle, percent=percent).collect()}
    found = sets(texts, shingle)
    want = classes(found, percent)
    assert got == {i: (len(found[i]), want[i], want[i] == i) for i in texts}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)] + [(200, j) for j in range(201, 260)]
    key = lambda i: i.to_bytes(2, "big")
    frame = spark.createDataFrame([(key(a), key(b)) for a, b in edges], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["comp"]) for r in neardup.components(frame).collect()}
    parent = {}
    for a, b in edges:
        parent.setdefault(a, a), parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {key(i): key(p) for i, p in parent.items() if i not in alone}


def test_bayes_rule_keeps_similar_pairs():
    rules = neardup.needed_matches(0.85, 1e-9, 76)
    assert rules[-1][0] == 76 and all(0 < m < n for n, m in rules)
    rng = np.random.default_rng(0)
    same = rng.random((20000, 76)) < 0.85
    a = np.zeros((20000, 76), np.uint32)
    assert neardup.plausible(rules, a, (~same).astype(np.uint32)).all()
    assert not neardup.plausible(rules, a, (rng.random((20000, 76)) > 0.2).astype(np.uint32)).any()


def edit_distance(item, words):
    """Least edit distance of item to any part of words, by the full table."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_myers_and_pigeonhole():
    rng = random.Random(3)
    hashes = WordHashes()
    words = [f"w{i}" for i in range(30)]
    for _ in range(60):
        item = [rng.choice(words) for _ in range(rng.randint(1, 80))]
        noise = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        copy = list(item)
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(copy) + 1)
            copy[at : at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
        doc = noise + copy + noise[::-1]
        best = edit_distance(item, doc)
        found = decontaminate.Matcher([(5, " ".join(item))]).search(" ".join(doc))
        if best <= int(decontaminate.RATE * len(item)):
            assert found[0][:2] == (5, best)
        else:
            assert not found
        bits = defaultdict(int)
        for j, h in enumerate(hashes.of([w.encode() for w in item]).tolist()):
            bits[h] |= 1 << j
        assert decontaminate.closest(bits, len(item), hashes.of([w.encode() for w in doc]).tolist())[0] == best


def test_decontamination_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    tokens = lambda t: t.lower().encode().translate(decontaminate.PUNCTUATION).split()
    want = set()
    for d in docs:
        text = tokens(d["text"])
        for i in items:
            item = tokens(i["text"])
            if len(set(item) & set(text)) >= 0.5 * len(set(item)):
                errors = edit_distance(item, text)
                if errors <= int(decontaminate.RATE * len(item)):
                    want.add((d["doc_id"], i["item_id"], errors))
    got = {(r["doc_id"], r["item_id"], r["errors"]) for r in queries.QUERIES["op5_decontamination"](spark, FOLDER).collect()}
    assert got == want and want


@pytest.mark.parametrize("n,dim,clusters", [(400, 8, 5), (150, 3, 150), (90, 16, 1)])
def test_dual_tree_is_exact(n, dim, clusters):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(clusters, dim))
    points = np.floor(256 * (centres[rng.integers(0, clusters, n)] + rng.normal(scale=0.2, size=(n, dim)))).astype(np.int64)
    points[n // 2 :: 7] = points[0]
    ids = np.arange(n) * 3
    asked = np.arange(0, n, 4)
    scores, rows = topk.search(points[asked], ids[asked], points, ids, 5)
    for i, q in enumerate(asked):
        products = points @ points[q]
        order = [j for j in np.lexsort((ids, -products)) if j != q][:5]
        assert list(rows[i]) == order and list(scores[i]) == list(products[order])


def test_cover_tree_invariants():
    points = np.random.default_rng(2).normal(size=(500, 4)) * 100
    tree = topk.CoverTree(points)
    for centre, radius, below, children in zip(tree.centre, tree.radius, tree.below, tree.children):
        assert np.linalg.norm(points[below] - points[centre], axis=1).max() <= radius + 1e-9
        if children is not None:
            assert sorted(np.concatenate([tree.below[c] for c in children])) == sorted(below)


def test_models_on_rows_they_have_not_seen(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    seen = [r for r in queries.QUERIES["op2_langid"](spark, folder).collect() if r["held_out"]]
    assert len(seen) > 100 and np.mean([docs[r["doc_id"]] == r["lang_pred"] for r in seen]) > 0.97
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for name, label, least in (("op4_toxicity", "toxic", 0.9), ("op8_quality", "quality", 0.93)):
        rows = [r for r in queries.QUERIES[name](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
        assert np.mean([labels[r["doc_id"]][label] == r["predicted"] for r in rows]) > least


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    d = langid.Direction.fresh(rng, 3)
    for name in ("table", "recur", "bias"):
        setattr(d, name, getattr(d, name).astype(np.float64))
    steps = rng.integers(0, 6, (5, 4))
    pull = rng.normal(size=(5, 4, 3))
    out, tape = d.forward(steps)
    grads = d.backward(steps, tape, pull)
    for name, g in zip(("table", "recur", "bias"), grads):
        w = getattr(d, name)
        for at in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(5)] + [(3, 2)] * (name == "table"):
            old = w[at]
            w[at] = old + 1e-5
            up = (d.forward(steps)[0] * pull).sum()
            w[at] = old - 1e-5
            down = (d.forward(steps)[0] * pull).sum()
            w[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-4)
    fast = langid.Direction(*(getattr(d, n).astype(np.float32) for n in ("table", "recur", "bias"))).states(steps)
    assert np.allclose(fast.transpose(0, 2, 1), out, atol=1e-5)


def test_ftrl_is_sparse():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600).astype(float)
    rows = [np.unique(np.append(rng.integers(10, 4000, 60), [3] if t else [])).astype(np.int32) for t in y]
    w = toxicity.ftrl(rows, y, bits=12)
    assert 3 in w.index and len(w.index) < 400 and w.value[list(w.index).index(3)] == max(w.value)


def test_pipeline(spark):
    """Each stage against its plain version, on what the stage before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    stages = dict(corpus_pipeline.STAGES)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = stages["language_id"](spark, frame(docs), FOLDER).collect()
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in docs if any(c.isalpha() for c in r["text"] or "")}
    texts = {r["doc_id"]: r["text"] for r in kept}
    unique = stages["near_duplicates"](spark, frame(kept), FOLDER).collect()
    lowest = classes(sets(texts, 5), 80)
    assert sorted(r["doc_id"] for r in unique) == sorted(i for i in texts if lowest[i] == i)
    clean = stages["decontamination"](spark, frame(unique), FOLDER).collect()
    leaked = {r["doc_id"] for r in queries.QUERIES["op5_decontamination"](spark, FOLDER).collect()}
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in unique if r["doc_id"] not in leaked)
    mixed = stages["mixture"](spark, frame(clean), FOLDER).collect()
    times = Counter(r["doc_id"] for r in mixed)
    assert set(times) <= {r["doc_id"] for r in clean} and max(times.values()) <= 2
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert words(mixed) == pytest.approx(1.5 * words(clean), rel=0.05)
    rows = stages["sharding"](spark, frame(mixed), FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in mixed)
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes[s] for s in range(24)) <= 1
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in whole) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows)
