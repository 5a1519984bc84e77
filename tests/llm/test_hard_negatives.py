import math
import random

import pytest
from pyspark.sql import functions as F

from eventide.llm import hard_negatives
from fixtures import clashing

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100):
    data = []
    for key, vector, label in rows:
        if key is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        data.append((key, (label + 1) % 10 if key % 7 == 0 else label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for key, label, vector in sorted({d for d in data if d[0] % every == 0}):
        scored = sorted((-max(-2**56, min(2**56, sum(a * b for a, b in zip(vector, other)))), k, other_label)
                        for k, other_label, other in data)
        for p, positive, _ in [s for s in scored if s[2] == label and s[1] != key][:5]:
            fits = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(key, positive, i + 1, k, -p, -s) for i, (s, k, _) in enumerate(fits)]
    return sorted(out)


def mined(df, every=100, **options):
    found = hard_negatives.mine(df, F.col("vec_id") % every == 0, **options)
    return sorted(map(tuple, found.collect()))


def random_rows(seed, n, ids, dims=4, labels=3):
    rng = random.Random(seed)
    values = [-0.5, -0.1, 0.0, 0.1, 0.3, 0.5, 0.52]
    return [(rng.choice(ids), [rng.choice(values) for _ in range(dims)], rng.randrange(labels)) for _ in range(n)]


@pytest.mark.parametrize("seed,tile,block", [(1, 16384, 2048), (2, 20, 7), (3, 9, 3)])
def test_random_rows_with_many_ties(spark, monkeypatch, seed, tile, block):
    monkeypatch.setattr(hard_negatives.packed, "__defaults__", (block,))
    rows = random_rows(seed, 300, range(-50, 400))
    want = brute(rows, 10)
    assert want and mined(spark.createDataFrame(rows, VECTORS), 10, tile=tile) == want


def test_one_very_common_vector(spark):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(700)] + random_rows(4, 200, range(700, 900), 2)
    want = brute(rows)
    assert want and mined(spark.createDataFrame(rows, VECTORS)) == want


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.25, 1.0], None), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1),
            (3, [float("nan"), 1.0], 2), (4, [float("inf"), 1.0], 2), (5, [1.0, 0.5], 1), (6, [], 1), (8, [0.9], 2),
            (9, [0.95, 0.5, 7.0], 2), (9, [0.95, 0.5, 7.0], 2), (200, [-1.0, -1.0], 5), (11, [-1.0, 0.25], 5), (12, [0.9, 0.4], 3)]
    want = brute(rows)
    assert want and mined(clashing(spark.createDataFrame(rows, VECTORS))) == want
    assert mined(spark.createDataFrame(rows, VECTORS).where("false")) == []


def test_very_large_components(spark):
    rows = [(0, [3e5, 1e6], 1), (1, [2e6, 1e6], 1), (2, [1e300, 1e300], 1), (3, [1.9e6, 1e6], 2), (4, [1.7e305, 1e5], 2), (5, [1e-300, 1e-320], 2)]
    assert mined(spark.createDataFrame(rows, VECTORS)) == brute(rows)


def test_an_anchor_without_positives_or_negatives(spark):
    assert mined(spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], VECTORS)) == []
    assert mined(spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [0.1], 2)], VECTORS)) == []
