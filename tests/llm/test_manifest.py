import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from eventide.llm import manifest
from fixtures import DOCS, clashing


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return sha(*[field(row[k]) for k in manifest.FIELDS])


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def brute(rows):
    """(id, leaf, subroot, root, proof, folded root) of every row, by whole trees."""
    groups = defaultdict(list)
    for row in rows:
        hit = row["doc_id"] is not None and row["n_chars"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
        given = leaf({**row, "n_chars": row["n_chars"] + 1}) if hit else leaf(row)
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), given, row["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, (_, _, own, given, key) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path, folded = [], given
            for tree, k in ((trees[g], i), (top, at)):
                for level in tree[:-1]:
                    other = level[k ^ 1] if k ^ 1 < len(level) else ""
                    path.append(other)
                    folded = sha(other, folded) if k & 1 else sha(folded, other)
                    k >>= 1
            out.append((key, own, trees[g][-1][0], top[-1][0], sha(*path), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def got(docs, **options):
    found = manifest.certified(docs, **options)
    return sorted(map(tuple, found.drop("log_place", "path").collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 21, 64, 100])
def test_places_are_those_of_the_log(n):
    leaves = [str(i) for i in range(n)]
    log, tree = manifest.build(leaves, manifest.height(n)), levels(leaves)
    assert len(log) == sum(map(len, tree)) and log[-1] == tree[-1][0]
    for level, nodes in enumerate(tree):
        for i, node in enumerate(nodes):
            assert log[manifest.place(i << level, level, n)] == node


def test_random_groups_odd_values_and_many_tiers(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "en", "de", "é", "Z", "", None])
        rows.append((None if i % 50 == 0 else rng.randrange(-300, 300), rng.choice(["a b", "", None, "ü" * 5]), lang,
                     rng.choice(["s", None, "", "x:1"]), rng.choice([None, 0, i, 2**40])))
    rows += rows[:9]
    docs = clashing(spark.createDataFrame(rows, DOCS))
    want = brute([r.asDict() for r in docs.collect()])
    # two leaves to a segment: many tiers, in the groups' trees and in the one above
    for bits in (1, 2, 10):
        assert got(docs, bits=bits) == want
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(5, "t", None, "s", 1)], DOCS)
    assert got(one) == brute([r.asDict() for r in one.collect()])
    assert got(one.where("false")) == []


def test_long_text_and_largest_count(spark):
    docs = spark.createDataFrame([(i, "ä" * 2_000_000 if i == 1 else "", "en", None, 2**63 - 1) for i in range(8)], DOCS)
    found = manifest.certified(docs).collect()
    assert all(r.verified for r in found)  # the largest count can not be raised
    assert {r.leaf for r in found} == {leaf(r.asDict()) for r in docs.collect()}


def test_path_proves_its_document(spark):
    docs = spark.createDataFrame([(i, str(i), "en" if i % 3 else "fr", "s", i) for i in range(50)], DOCS)
    for r in manifest.certified(docs, bits=2).collect():
        assert manifest.fold(r.leaf, r.path) == r.root
        assert manifest.fold(sha("other"), r.path) != r.root
