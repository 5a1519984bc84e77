import hashlib
import random
import re

import numpy as np
from fixtures import clashing, documents, rows

from eventide.llm import decontamination
from eventide.llm.fm_index import FMIndex, WaveletMatrix, suffix_order


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    out = []
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, phrase in items:
            if item is None or not words(phrase):
                continue
            w = words(phrase)
            n = min(13, len(w))
            for i in range(len(w) - n + 1):
                for p in range(len(own) - n + 1):
                    if own[p:p + n] == w[i:i + n]:
                        hit.update(range(p, p + n))
                        found.add(str(item))
        ids = ",".join(sorted(found))
        out.append((key, len(own), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


def sample():
    rng = random.Random(3)
    vocabulary = ["an", "be", "Co", "dé", "e1", "ff"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([14, 16, 20])))) for i in range(12)]
    items += [(20, "an be"), (21, None), (22, "!!"), (None, "an be co"), (9, items[0][1]), (100, "unseen words here")]
    docs = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(0, 6)):
            text.append(rng.choice(items[:12])[1] if rng.random() < 0.5 else
                        " ".join(rng.choice(vocabulary + ["zz"]) for _ in range(rng.randrange(1, 30))))
        docs.append((i, ", ".join(text)))
    return docs + [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1])], items


def test_against_brute_force(spark):
    docs, items = sample()
    df = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontamination.contamination(df, bench)) == brute(docs, items)
    blocks = decontamination.contamination(clashing(df), bench, block_bytes=60, shard_bytes=500)
    assert rows(blocks) == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.contamination(documents(spark, ["a b"]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]
    assert decontamination.contamination(documents(spark, []), none).collect() == []


def test_fm_index():
    rng = np.random.default_rng(0)
    sequence = rng.integers(0, 5, 300)
    sequence[-1] = 0
    index = FMIndex(sequence, 5)
    for size in (1, 2, 3, 4):
        phrase = rng.integers(1, 5, size)
        padded = np.concatenate([np.zeros(4 - size, np.int64), phrase])[None]
        low, high = index.search(padded)
        want = [i for i in range(300 - size + 1) if (sequence[i:i + size] == phrase).all()]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_wavelet_and_suffixes():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 9, 200)
    matrix = WaveletMatrix(symbols, 9)
    assert matrix.at(np.arange(200)).tolist() == symbols.tolist()
    for s in range(9):
        ends = np.arange(201)
        assert matrix.rank(np.full(201, s), ends).tolist() == [int((symbols[:e] == s).sum()) for e in ends]
    text = rng.integers(0, 3, 150)
    order = suffix_order(text)
    assert order.tolist() == sorted(range(150), key=lambda i: text[i:].tolist())
