import random

import xxhash
from fixtures import clashing, documents, rows

from eventide.llm import components, simhash


def brute_fingerprint(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(docs):
    prints = [brute_fingerprint(t) for _, t in docs]
    least = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for i in range(len(docs)):
            for j in range(len(docs)):
                if (prints[i] ^ prints[j]).bit_count() <= 2 and docs[least[j]][0] < docs[least[i]][0]:
                    least[i], changed = least[j], True
    return sorted(((d, f"{p:016x}", docs[k][0]) for (d, _), p, k in zip(docs, prints, least)), key=str)


def sample():
    rng = random.Random(2)
    words = ["alpha", "Beta", "gamma", "É", "delta x", "eps\tzeta", "eta"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += [t + " more" for t in texts[:20]] + texts[:15] + [None, "", "  ", "one", "One", "one two"]
    long = [" ".join(str(i) for i in range(400))] + [" ".join(str(i) for i in range(k, 400)) for k in range(1, 12)]
    return [(1000 - i, t) for i, t in enumerate(texts + long)]


def test_against_brute_force(spark):
    docs = sample()
    df = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    assert rows(simhash.near_duplicates(df)) == brute(docs)
    assert rows(simhash.near_duplicates(clashing(df))) == brute(docs)


def test_chain_of_links(spark):
    fps = [0]
    for bit in range(0, 40, 2):
        fps.append(fps[-1] ^ (3 << bit))
    links = simhash.near_links(spark.createDataFrame([(f,) for f in fps + [7 << 60, -1]], "fp long"))
    found = components.components(links)
    assert {r.node: r.root for r in found.collect()} == {f: min(fps) for f in fps}


def test_empty_null_and_repeated(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    df = documents(spark, ["a b c d", "a b c d", "a b c d"], [None, 7, 7])
    assert [r.component_id for r in simhash.near_duplicates(df).collect()] == [7, 7, 7]
    assert simhash.near_duplicates(documents(spark, ["x"], [None])).first().component_id is None


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 5), (3, 2), (None, 4), (20, 3), (11, 30), (30, 12)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {1: 1, 2: 1, 3: 1, 20: 1, 10: 10, 11: 10, 30: 10, 12: 10}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
