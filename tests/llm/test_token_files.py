import random
import zlib

import numpy as np
import public_tokenizers
from fixtures import clashing, documents
from tokenizers import Tokenizer

from eventide.llm import token_files
from eventide.llm.perfect_hash import PerfectHash

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-2**62, 2**62, 20_000))
    index = PerfectHash.load(PerfectHash.build(keys).dump())
    assert sorted(index.numbers(keys)) == list(range(len(keys)))
    assert PerfectHash.build(keys[:0]).numbers(keys[:3]).tolist() == [-1, -1, -1]


def test_words_as_the_library_gives_them():
    rng = random.Random(1)
    parts = ["a", "b", "The", " ", "'s", "'T", "\x1c", "é", "É", "日", "क़", "%", "1", "23", ".", ",,", "ING", "İ", "Σ", "ς",
             "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "_", " ", " ", "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 12))) for _ in range(3000)]
    library = Tokenizer.from_file(PATH)
    coder = token_files.WordEncoder(PATH)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(c, coder.kind).tolist() for c in coder.encode(texts)] == want


def test_round_trip(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "Cat", "sat!", "naïve", "日"]) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    texts += [None, "", "word " * 4000]
    ids = rng.sample(range(-500, 500), len(texts))
    folder = str(tmp_path / "ids")
    token_files.write_ids(clashing(documents(spark, texts, ids)), folder, PATH, block_bytes=500, keys_per_bucket=10)
    library, at, want = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(zip(ids, texts)):
        codes = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((key, at, len(codes), zlib.crc32(codes.tobytes()), True))
        at += len(codes)
    got = sorted(tuple(r) for r in token_files.checked(spark, folder).collect())
    assert got == want
    keys = spark.createDataFrame([(ids[0],), (ids[5],), (10**9,), (None,), (ids[0],)], "doc_id long")
    found = {r.doc_id: r.ids for r in token_files.fetch(keys, folder).collect()}
    assert found == {k: library.encode(texts[ids.index(k)] or "", add_special_tokens=False).ids + [2] for k in (ids[0], ids[5])}
    whole = {r.doc_id: len(r.ids) for r in token_files.read_ids(spark, folder).collect()}
    assert whole == {w[0]: w[2] for w in want}


def test_one_key_reads_one_bucket_and_one_block(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BUCKETS_PER_PART", 2)
    texts = [f"word{i} and more of it " * (i % 7) for i in range(300)]
    folder = str(tmp_path / "ids")
    token_files.write_ids(documents(spark, texts), folder, PATH, block_bytes=2000, keys_per_bucket=10)
    library = Tokenizer.from_file(PATH)
    for key in (0, 17, 299):
        index, block = token_files.key_rows(spark, folder, key)
        assert index.count() == 1 and block.count() == 1
        # folders are picked by name; the bucket and the block are picked inside by a filter that reaches the files
        for rows in (index, block):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(" in plan and "PushedFilters: [IsNotNull(b" in plan and "EqualTo(b" in plan
        assert token_files.fetch_key(spark, folder, key) == library.encode(texts[key], add_special_tokens=False).ids + [2]
    assert token_files.fetch_key(spark, folder, 10**12) is None
    token_files.write_ids(documents(spark, []), str(tmp_path / "none"), PATH)
    assert token_files.fetch_key(spark, str(tmp_path / "none"), 1) is None


def test_known_words_are_let_go(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_BYTES", 2000)
    coder, library = token_files.WordEncoder(PATH), Tokenizer.from_file(PATH)
    for i in range(30):
        texts = [f"some{i} words{j} here!" for j in range(10)] + ["x" * 5000, "日本" * 300]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(c, coder.kind).tolist() for c in coder.encode(texts)] == want
    assert len(coder.known) < 100


def test_empty_null_and_repeated(spark, tmp_path):
    token_files.write_ids(documents(spark, []), str(tmp_path / "none"), PATH)
    assert token_files.checked(spark, str(tmp_path / "none")).collect() == []
    df = documents(spark, ["b", "a", "c", "d"], [4, 4, None, 1])
    token_files.write_ids(df, str(tmp_path / "some"), PATH)
    got = token_files.checked(spark, str(tmp_path / "some")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 4, 4]
    assert [r.keyed for r in got] == [False, True, True, False]
    assert [r.start for r in got] == [0, 2, 4, 6]
