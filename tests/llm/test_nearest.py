import numpy as np
from fixtures import clashing

from eventide.llm import nearest

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(ids, vectors, queries, k):
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    out = {}
    for q in queries:
        score = (vectors * vectors[q]).sum(axis=1) / (norms * norms[q])
        score[q] = -9
        out[int(ids[q])] = [int(ids[i]) for i in np.lexsort((ids, -score))[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 24))
    vectors = centres[rng.integers(0, 30, 1500)] + 0.5 * rng.standard_normal((1500, 24))
    vectors[200:400] = vectors[200]  # a group of equal vectors: ties go to the smaller id
    ids = rng.permutation(1500)
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)], SCHEMA).repartition(4)
    queries = np.flatnonzero(ids % 50 == 0)
    want = brute(ids, vectors, queries, 5)
    got = found(nearest.search(clashing(df), df.where("vec_id % 50 = 0"), query_rows=7, block_rows=300))
    assert got.keys() == want.keys()
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    equal = [q for q in queries if 200 <= q < 400]
    assert all(got[int(ids[q])] == want[int(ids[q])] for q in equal)


def test_unusable_few_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, [0.0, 3.0]), (10, [1.0, 2.0, 3.0]), (1, [2.0, 0.1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = found(nearest.search(df, df))
    assert got == {0: [1, 9], 1: [0, 9], 9: [1, 0]}
    none = df.limit(0)
    assert nearest.search(none, none).collect() == [] and nearest.search(none, df).collect() == []
    assert nearest.search(df, none).collect() == []


def test_huge_and_tiny_components(spark):
    """Scores are those of the same directions at an ordinary length, to the last digit."""
    plain = [[3.0, 4.0], [1.0, 2.0], [-1.0, 0.5], [2.0, 2.0]]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(plain)], SCHEMA)
    sizes = [2.0 ** 1020, 2.0 ** -1060, 1.0, 2.0 ** 700]
    odd = spark.createDataFrame([(i, [x * m for x in v], 0) for i, (v, m) in enumerate(zip(plain, sizes))], SCHEMA)
    want = nearest.search(df, df).orderBy("query_id", "rank").collect()
    assert nearest.search(odd, odd).orderBy("query_id", "rank").collect() == want and len(want) == 12
