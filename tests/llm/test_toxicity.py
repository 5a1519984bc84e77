import random
import zlib

import numpy as np
import pytest
from fixtures import clashing, documents

from eventide.llm import string_kernel, toxicity

SYLLABLES = ["an", "er", "tho", "ri", "mel", "ka", "so", "ting", "ble", "wo"]


def corpus(n=500):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))
    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 40))]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "dimwit", "numbskull"]))
        texts.append(" ".join(words) + ".")
        labels.append((i, int(i % 2), int(bad)))
    return texts, labels


@pytest.fixture(scope="module")
def trained(spark):
    texts, labels = corpus()
    df = documents(spark, texts)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return df, labels, toxicity.train(df, marks)


def test_held_out_accuracy(spark, trained):
    df, labels, model = trained
    truth = {d: t for d, _, t in labels}
    held = [r for r in toxicity.score(clashing(df), model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_gaps_and_odd_rows(spark, trained):
    _, _, model = trained
    calm = "tho ri mel ka so ting ble wo an er " * 2
    texts = [calm, calm + "d.i.m.w.i.t dimwit dim-wit", calm + "n u m b s k u l l numbskull d1mwit", None, "", calm + "blockxhead dimwiit numbskkull"]
    got = {r.doc_id: r for r in toxicity.score(documents(spark, texts), model).collect()}
    assert [got[i].predicted for i in range(5)] == [0, 1, 1, 0, 0]
    assert got[5].score > got[0].score and all(0 <= r.score <= 1 for r in got.values())


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = documents(spark, ["a b", None])
    assert [r.predicted for r in toxicity.score(df, toxicity.train(df, none)).collect()] == [0, 0]
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.score(documents(spark, []), toxicity.train(documents(spark, []), odd)).collect() == []


def test_kernel():
    def plain(s, t):
        def grams(w):
            out = {}
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, len(w)):
                        if k - i < string_kernel.SPAN:
                            key = (w[i], w[j], w[k])
                            out[key] = out.get(key, 0) + string_kernel.DECAY ** (k - i + 1)
            return out
        a, b = grams(f"|{s}|"), grams(f"|{t}|")
        dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
        return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5
    words = ["banana", "bananas", "bxanana", "cat", "aaaaaa", "réeux"]
    likeness, table = string_kernel.gram(words)
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert likeness[i, j] == pytest.approx(plain(s, t), abs=1e-9)
    assert np.allclose(table.times(words), likeness, atol=1e-5)
    assert string_kernel.units("i-d.i0t!") == ["i", "d", "iot", "idiot"]
    assert all(len(u) <= string_kernel.LONGEST for u in string_kernel.units("x" * 500))
