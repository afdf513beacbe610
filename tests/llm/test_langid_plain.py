"""Language identification against the network written out byte by byte."""

import random

import numpy as np
import pytest

from sievemark.llm import langid


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_states(direction, data):
    hidden = direction.recur.shape[0]
    h, out = np.zeros(hidden), []
    for byte in data:
        x = direction.table[byte].astype(float) + direction.bias
        y = h @ direction.recur.astype(float)
        update, reset = sigmoid(x[:hidden] + y[:hidden]), sigmoid(x[hidden : 2 * hidden] + y[hidden : 2 * hidden])
        new = np.tanh(x[2 * hidden :] + reset * y[2 * hidden :])
        h = update * h + (1 - update) * new
        out.append(h)
    return out


def plain_prediction(model, text):
    """Mean of the softmax over all bytes, window by window; the last one is filled up with zero bytes."""
    data, total = text.encode(), np.zeros(len(model.langs))
    for start in range(0, len(data), langid.WINDOW):
        part = data[start : start + langid.WINDOW]
        filled = part.ljust(langid.WINDOW, b"\0")
        ahead, behind = plain_states(model.ahead, filled), plain_states(model.behind, filled[::-1])[::-1]
        for a, b in list(zip(ahead, behind))[: len(part)]:
            logits = np.concatenate([a, b]) @ model.out.astype(float) + model.shift
            p = np.exp(logits - logits.max())
            total += p / p.sum()
    mean = total / len(data)
    return model.langs[mean.argmax()], mean.max()


def test_predictions_against_the_plain_network(spark):
    rng = random.Random(2)
    letters = {"aa": "abcde fg", "bb": "uvwxy zé", "cc": "мнопр ст"}
    word = lambda lang, n: "".join(rng.choice(letters[lang]) for _ in range(n))
    seen = [(word(lang, 60), i) for i, lang in enumerate(letters) for _ in range(40)]
    model = langid.train([t.encode() for t, _ in seen], [k for _, k in seen], list(letters), steps=25)
    texts = [word(lang, n) + "a" for lang in letters for n in (1, 63, 64, 65, 500)] + ["a", "uu " * 700 + "аб"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, "123 !"), (103, texts[3])]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        lang, score = plain_prediction(model, text)
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-4)
    assert got[100] == got[101] == got[102] == (langid.UNKNOWN, 0.0) and got[103] == pytest.approx(got[3])
    assert [got[4][0], got[9][0], got[14][0]] == list(letters)
