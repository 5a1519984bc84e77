import re

from fixtures import clashing, documents

from eventide.llm import licenses
from eventide.llm.license_rules import BASE, rules as all_rules

TEXTS = [
    "Released under the MIT License. The mit-license and an Apache License; not amit license.",
    "GNU Lesser General Public License v2.1 applies", "SPDX-License-Identifier: GPL-2.0-only",
    "Licensed under the Apache License, Version 2.0", None, "", "nothing here", "mit", "MIT License mit license " * 300,
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "GENERAL PUBLIC license",
]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_base_places(spark):
    got = {r.doc_id: r for r in licenses.summary(clashing(documents(spark, TEXTS))).collect()}
    for i, text in enumerate(TEXTS):
        own = words(text)
        places = [(p, label) for label, phrase in BASE for p in range(len(own)) if own[p:p + len(phrase.split())] == phrase.split()]
        at = [p for p, _ in places]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(own), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1


def test_containment(spark):
    got = {r.doc_id: r for r in licenses.summary(documents(spark, TEXTS)).collect()}
    assert got[1].labels == "gpl,lgpl-2.1" and got[1].n_suppressed >= 2
    assert got[2].labels == "gpl-2.0" and got[2].n_base == 0
    assert got[3].labels == "apache,apache-2.0"
    assert got[9].labels == "mit" and got[9].base_labels == ""
    found = [("a", 5, 0.5, 0, 4), ("b", 5, 0.5, 1, 3), ("c", 7, 0.5, 1, 3), ("d", 5, 0.5, 3, 6), ("e", 5, 0.5, 3, 6)]
    kept = {d[0] for d in licenses.suppressed(found) if d[5]}
    assert kept == {"a", "c", "d"}


def test_against_plain_suppression():
    import random
    rng = random.Random(2)
    for _ in range(200):
        found = []
        for i in range(rng.randrange(1, 12)):
            start = rng.randrange(8)
            found.append((str(i), rng.choice([3, 5, 7]), 0.5, start, start + rng.randrange(1, 6)))
        def beats(x, y):
            within = x[3] <= y[3] and x[4] >= y[4]
            if not within or x is y or x[1] < y[1]:
                return False
            return (x[3], x[4]) != (y[3], y[4]) or x[1] > y[1] or found.index(x) < found.index(y)
        want = {y[0] for y in found if not any(beats(x, y) for x in found)}
        assert {d[0] for d in licenses.suppressed(found) if d[5]} == want


def test_rules_and_empty(spark):
    assert len(all_rules()) > 200
    assert licenses.summary(documents(spark, [])).collect() == []


def alternatives(pattern):
    """Every text that a rule's pattern spells out; `\\w+` stands for one word."""
    def each(items):
        texts = [""]
        for op, value in items:
            name = str(op)
            if name == "LITERAL":
                own = [chr(value)]
            elif name == "IN":
                own = ["file"] if str(value[0][0]) == "CATEGORY" else [chr(c) for _, c in value]
            elif name == "BRANCH":
                own = [t for branch in value[1] for t in each(branch)]
            elif name == "SUBPATTERN":
                own = each(value[3])
            elif name == "MAX_REPEAT":
                own = ([""] if value[0] == 0 else []) + each(value[2])
            else:
                assert name == "ASSERT_NOT"
                own = [""]
            texts = [a + b for a in texts for b in own]
        return texts
    return each(re._parser.parse(pattern.decode()))


def test_no_alternative_is_lost_to_the_keywords():
    for rule in all_rules():
        gated, free = (licenses.Scanner([], [r]) for r in (rule, rule._replace(keywords=frozenset())))
        for text in alternatives(rule.pattern.pattern):
            found = free.scan(text.encode())[2]
            assert found and gated.scan(text.encode())[2] == found, (rule.label, text)


def test_labels_without_the_other_word(spark):
    texts = ["Licensed under the Expat license", "GNU Library General Public License version 2",
             "Copying is strictly prohibited", "Public Domain Dedication and License"]
    got = {r.doc_id: r for r in licenses.summary(documents(spark, texts)).collect()}
    assert [got[i].labels for i in range(4)] == ["mit", "gpl,lgpl-2.0", "proprietary", "pddl"]
    assert got[0].n_found == 2 and got[2].n_found == 1
