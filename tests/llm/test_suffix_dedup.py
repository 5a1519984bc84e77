import hashlib
import random

import numpy as np
import pyarrow as pa
from fixtures import clashing, documents, rows

from eventide.llm import collection_bwt, suffix_dedup


def brute(docs):
    key = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            first[data[i:i + 50]] = min(key(d), first.get(data[i:i + 50], 2**63 - 1))
    out = []
    for d, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 49):
            if first[data[i:i + 50]] < key(d):
                gone[i:i + 50] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((d, len(data), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def sample():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(60, 200))) for _ in range(15)]
    docs = [(i, "".join(rng.choice(base)[rng.randrange(0, 50):rng.randrange(55, 200)] + "x" * rng.randrange(0, 3)
                        for _ in range(rng.randrange(0, 8)))) for i in range(120)]
    return docs + [(200, None), (201, ""), (None, base[0] * 2), (203, "a" * 500), (204, "a" * 400 + "b"),
                   (205, "ab" * 300), (205, "ab" * 300), (5, base[3] + base[4]), (206, "\x00" * 120), (207, "\x00" * 80)]


def test_against_brute_force(spark):
    docs = sample()
    df = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    want = brute(docs)
    assert rows(suffix_dedup.digests(clashing(df).drop("id"))) == want
    assert rows(suffix_dedup.digests(df, shard_bytes=2000)) == want
    assert rows(suffix_dedup.digests(df, shard_bytes=1000, hot_shards=2)) == want


def test_collections(spark, monkeypatch):
    docs = sample()
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 5)
    monkeypatch.setattr(suffix_dedup, "RANGE_KEYS", 50)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 2000)
    df = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    assert rows(suffix_dedup.digests(df, shard_bytes=3000)) == brute(docs)


def test_stretches_do_not_depend_on_place(monkeypatch):
    texts = [t.encode() for _, t in sample() if t]
    def stretches(order, block):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        shard = suffix_dedup.Shard(list(order), [texts[i] for i in order])
        return sorted((order[d], int(b - shard.starts[d]), int(e - shard.starts[d]), int(k))
                      for d, b, e, k in zip(shard.doc, shard.begin, shard.end, shard.key))
    order = list(range(len(texts)))
    want = stretches(order, 1 << 19)
    assert stretches(order, 37) == want and stretches(order[::-1], 64) == want


def letters(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def telling_gram(rng):
    """Some letters of which the hash is the least in most windows around them."""
    grams = [letters(rng, 20) for _ in range(1000)]
    return min(grams, key=lambda g: suffix_dedup._gram_hashes(np.frombuffer(g.encode(), np.uint8), 20)[0])


def sent_by(texts, hot_shards):
    """What each of the texts sends, as a shard of its own, when keys in so many shards count as hot."""
    shards = [pa.table({"shard": pa.array([i], pa.int64()), "doc_id": pa.array([i], pa.int64()), "text": [t]})
              for i, t in enumerate(texts)]
    marks = suffix_dedup._flag(hot_shards)(pa.concat_tables(map(suffix_dedup._report(1), shards)))
    return pa.concat_tables(suffix_dedup._send(1)(s, marks.filter(np.array(marks["shard"]) == i))
                            for i, s in enumerate(shards))


def test_hot_keys_send_little_more_than_others():
    """Half of a gram's longest way to the left, or to the right: two parts of a segment, not one for each window."""
    rng = random.Random(21)
    gram = telling_gram(rng)
    texts = [letters(rng, 100) + gram + letters(rng, 100) for _ in range(300)]
    plain, hot = sent_by(texts, 1000), sent_by(texts, 200)
    n, size = (sum(plain["n"].to_pylist()), sum(sum(b) for b in plain["sizes"].to_pylist()))
    assert n >= 250 and n < sum(hot["n"].to_pylist()) <= 2 * n
    assert sum(sum(b) for b in hot["sizes"].to_pylist()) <= 2 * size


def test_parts_are_the_same_in_all_surroundings():
    """Two stretches that have a window in common have it in parts of one name, at each level; at the last one, parts of
    one name begin with the same window."""
    rng = random.Random(4)
    texts = [("".join(rng.choice(("ab", "abc", "x" * 30, letters(rng, 3))) for _ in range(60))).encode() for _ in range(60)]
    texts += [texts[0][20:150] + texts[1][10:140], b"ab" * 80, b"xy" + b"ab" * 70, b"\0" * 99, b"a" * 70 + b"\0" * 70]
    shard = suffix_dedup.Shard(list(range(len(texts))), texts)
    for level in range(1, suffix_dedup.LEVELS + 1):
        _, first, stop, name = shard.parts(np.arange(len(shard.begin)), level)
        assert sum(stop - first) == sum(shard.end - shard.begin)
        names, windows = {}, {}
        for a, b, key in zip(first.tolist(), stop.tolist(), name.tolist()):
            for i in range(a, b):
                names.setdefault(shard.data[i:i + 50], set()).add(key)
                windows.setdefault(key, set()).add(shard.data[i:i + 50])
        assert {len(k) for k in names.values()} == {1}
    assert {len(w) for w in windows.values()} == {1}


def test_segments_that_share_a_gram_alone_stay_out_of_the_bwt(monkeypatch):
    """A gram with other surroundings each time gives no equal windows; a passage of two documents does."""
    rng = random.Random(22)
    gram, passage = telling_gram(rng), letters(rng, 90)
    texts = [letters(rng, 80) + gram + letters(rng, 80) for _ in range(200)]
    met = []
    smallest = suffix_dedup._smallest
    monkeypatch.setattr(suffix_dedup, "_smallest", lambda some, docs: met.extend(some) or smallest(some, docs))
    suffix_dedup._meet(sent_by(texts, 1000))
    assert met == []
    sent = sent_by([*texts, "begin" + passage + "one", "other" + passage + "two"], 1000)
    answers = [suffix_dedup._unplaned(r["a"]).view(np.int64) for r in suffix_dedup._meet(sent).to_pylist()]
    assert met and (answers[-1] == 200).sum() == 41


def test_strings_of_one_hash_are_told_apart(monkeypatch):
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(50, 53))) for _ in range(40)] * 2
    size = np.array([len(t) for t in texts])
    key = np.array([rng.randrange(3) for _ in range(40)] * 2, np.uint64)
    packed = suffix_dedup._rows(b"".join(texts), np.cumsum(size) - size, size)
    for constant in (False, True):
        if constant:
            monkeypatch.setattr(suffix_dedup, "_mixed", lambda values: values * np.uint64(0))
        one, number = suffix_dedup._numbered(key, packed, size)
        assert len(one) == len(set(zip(key.tolist(), texts))) and (np.diff(key[one].astype(np.int64)) >= 0).all()
        assert [(key[one[n]], texts[one[n]]) for n in number] == list(zip(key, texts))


def test_without_repeats(spark):
    shared = "é" * 40 + "the shared passage"
    df = documents(spark, ["start " + shared, "x" + shared + "� end", shared, "", None, "own"])
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(df).collect()}
    assert got[0].text == "start " + shared and got[5].text == "own"
    assert got[1].text == "x� end" and got[1].n_chars == 6 and got[1].source == "src1"
    assert 2 not in got and got[3].text == "" and 4 in got
    assert suffix_dedup.without_repeats(documents(spark, [])).collect() == []


def test_no_character_is_made_of_two_others(spark):
    """A span that begins inside one character and ends inside another takes both."""
    shared = "s" * 60
    df = documents(spark, ["\u0129" + shared + "\u00e8", "begin \u00e9" + shared + "\u00ea fin"])
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(df).collect()}
    assert got[1] in ("begin  fin", "begin \u00e9\u00ea fin", "begin \u00e9 fin", "begin \u00ea fin")
    assert set(got[1]) <= set("begin \u00e9\u00ea fin")


def test_kept_characters_against_brute_force(spark):
    """Whatever bytes go, the rest is the document's own characters with none of their bytes removed."""
    rng = random.Random(12)
    letters = ["a", "b", "\u00e9", "\u00e8", "\u0129", "\u65e5", "\u65e6", "\u66e5", "\U0001f600", "\U0001f601", "\U0001f640"]
    shared = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30)))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(shared)
            at = rng.randrange(10)
            parts += [passage[at:], rng.choice(letters)]
        texts.append("".join(parts))
    spans = {r[0]: r[1] for r in spans_of(texts)}
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        covered, at, kept = spans[i], 0, []
        for character in text:
            size = len(character.encode())
            if not any(covered[at:at + size]):
                kept.append(character)
            at += size
        assert got.get(i, "") == "".join(kept)


def spans_of(texts):
    """(id, which bytes go) by comparing all 50-byte strings."""
    seen, out = set(), []
    for i, text in enumerate(texts):
        data = text.encode()
        windows = [data[j:j + 50] for j in range(len(data) - 49)]
        covered = [False] * len(data)
        for j, w in enumerate(windows):
            if w in seen:
                covered[j:j + 50] = [True] * 50
        seen.update(windows)
        out.append((i, covered))
    return out


def test_bwt_and_common_prefixes():
    rng = random.Random(1)
    for trial in range(150):
        letters = b"ab" if trial % 2 else b"abcd"
        texts = [bytes(rng.choice(letters) for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(1, 8))]
        bwt, lcp, owner, length = collection_bwt.build(texts)
        got = [(texts[o][len(texts[o]) - n:], int(o), int(n)) for o, n in zip(owner, length)]
        want = sorted((t[len(t) - n:], i, n) for i, t in enumerate(texts) for n in range(len(t) + 1))
        assert sorted(got) == want and [g[0] for g in got] == [w[0] for w in want]
        for k, (suffix, o, n) in enumerate(got):
            assert bwt[k] == (0 if n == len(texts[o]) else texts[o][len(texts[o]) - n - 1] + 1)
            if k:
                other = got[k - 1][0]
                common = next((i for i, (x, y) in enumerate(zip(suffix, other)) if x != y), min(len(suffix), len(other)))
                assert lcp[k] == common
