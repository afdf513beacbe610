"""Decontamination: runs chosen by their frequency, groups of items, items that begin alike."""

import itertools
import random

import numpy as np
import pytest

from sievemark.llm import decontaminate

PREFIX = "answer the following question with one letter and explain briefly why".split()


def test_rare_runs_against_all_choices():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, size = int(rng.integers(3, 14)), int(rng.integers(1, 4))
        common, wanted = rng.integers(1, 5, n - size + 1).astype(float), int(rng.integers(1, n // size + 1))
        got = decontaminate.rare_runs(common, size, wanted)
        assert len(got) == wanted and all(b - a >= size for a, b in zip(got, got[1:])) and got[0] >= 0
        choices = itertools.combinations(range(len(common)), wanted)
        assert common[got].sum() == min(common[list(c)].sum() for c in choices if all(b - a >= size for a, b in zip(c, c[1:])))


def alike(count):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(5000)]
    return [(i, " ".join(PREFIX + [rng.choice(words) for _ in range(50)])) for i in range(count)], rng, words


def test_items_that_begin_alike_cost_nothing_at_their_common_phrase(monkeypatch):
    items, rng, words = alike(1000)
    verified, plain = [], decontaminate.closest
    monkeypatch.setattr(decontaminate, "closest", lambda *a: verified.append(a) or plain(*a))
    matcher = decontaminate.Matcher(items)
    text = " ".join(" ".join(PREFIX + [rng.choice(words) for _ in range(60)]) for _ in range(50))
    assert matcher.search(text) == [] and len(verified) <= 5
    assert [hit[:2] for hit in matcher.search(text + " " + items[7][1])] == [(7, 0)]


def test_items_of_one_phrase_only_are_still_found():
    """No rare run at all: every item is the phrase with a word more."""
    items = [(i, " ".join([*PREFIX, f"w{i}"])) for i in range(40)]
    found = decontaminate.Matcher(items).search("so " + " ".join(PREFIX) + " w3 then")
    assert [h[0] for h in found] == list(range(40)) and found[3][1] == 0 and all(h[1] == 1 for h in found if h[0] != 3)


@pytest.mark.parametrize("group_bytes", [decontaminate.GROUP_BYTES, 2000])
def test_groups_give_the_same_hits(spark, monkeypatch, group_bytes):
    """Several groups, an id with several texts, repeated rows, a very long item."""
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", group_bytes)
    items, rng, words = alike(60)
    long = " ".join(rng.choice(words) for _ in range(3000))
    items += [(5, "an entirely different text of the same id as another one"), (900, long), *[items[9]] * 50, (None, items[3][1]), (901, None)]
    texts = ["x " + items[4][1] + " y", items[5][1] + " an entirely different text of the same id as other one", long.upper(), " ".join(PREFIX), "", None, items[9][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.occurrences(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["errors"]) for r in got) == [(0, 4, 0), (1, 5, 0), (2, 900, 0), (6, 9, 0)]
