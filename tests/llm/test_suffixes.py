"""Suffix-array deduplication against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from sievemark.llm import suffixes


def plain(texts, length):
    """Kept bytes of every text, by counting all windows."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out.append((bytes(np.frombuffer(d, np.uint8)[~gone]), spans))
    return out


@pytest.mark.parametrize("symbols", [1, 2, 3, 20])
def test_suffix_array(symbols):
    rng = random.Random(symbols)
    for _ in range(300):
        text = [rng.randrange(symbols) for _ in range(rng.randrange(40))]
        assert suffixes.suffix_array(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def corpus(rng, length):
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(length // 2, 3 * length))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(2 * length))) for _ in range(rng.randrange(4))]
        text = "".join(parts)
        if text and rng.random() < 0.3:
            cut = rng.randrange(len(text))
            text = text[:cut] + "X" + text[cut + 1 :]
        texts.append(text)
    return [*texts, *texts[:5], None, "", "a" * 5 * length, "ab" * 4 * length, "x" + "ab" * 3 * length, "é" * length]


@pytest.mark.parametrize("group_bytes", [suffixes.GROUP_BYTES, 60])
@pytest.mark.parametrize("length", [4, 7, 25])
def test_against_counted_windows(spark, length, group_bytes):
    texts = corpus(random.Random(length), length)
    docs = spark.createDataFrame([(i % 50 or None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, h string, spans int")
    got = suffixes.remove_repeats(docs, length, group_bytes).collect()
    wanted = plain(texts, length)
    assert sorted((r.doc_id or 0, bytes(r.kept), [(s["start"], s["end"]) for s in r.spans]) for r in got) == sorted(
        (i % 50, kept, spans) for i, (kept, spans) in enumerate(wanted)
    )


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 64)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(3000)), "".join(rng.choice("abc") for _ in range(1000))]
    found: dict = {}
    for batch in suffixes.pieces([t.encode() for t in texts], 12):
        for number, offset, part in batch:
            for i in range(len(part) - 11):
                found.setdefault(number, []).append(offset + i)
    assert [sorted(found[i]) for i in (0, 1)] == [list(range(len(t) - 11)) for t in texts]


def test_empty_table_and_short_texts(spark):
    schema = "doc_id long, text string"
    assert suffixes.remove_repeats(spark.createDataFrame([], schema)).collect() == []
    rows = suffixes.remove_repeats(spark.createDataFrame([(None, None), (1, ""), (1, "short"), (1, "short")], schema)).collect()
    assert sorted(bytes(r.kept) for r in rows) == [b"", b"", b"short", b"short"] and all(r.spans == [] for r in rows)


def test_query(spark):
    import pyarrow.parquet as pq

    folder = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    wanted = [
        (i, len((t or "").encode()), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, t, (kept, spans) in zip(docs["doc_id"], docs["text"], plain(docs["text"], 400), strict=True)
    ]
    got = [tuple(r) for r in entry.queries()["op12_suffixes"](spark, folder).collect()]
    assert sorted(got) == sorted(wanted) and sum(r[2] for r in wanted) > 0
