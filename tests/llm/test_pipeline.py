import random

import corpus_pipeline
import public_tokenizers
import sentencepiece
from test_decontamination import brute as hits
from test_simhash import brute as groups
from test_suffix_dedup import brute as repeats

import __spark_entry__ as contract

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sample():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["an", "er", "tho", "ri", "mel", "ka", "so"]) for _ in range(rng.randrange(1, 4)))
    item = " ".join(word() for _ in range(20))
    shared = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(rng.randrange(30, 120))) for _ in range(40)]
    texts[5] = texts[4]
    texts[8] += " " + shared
    texts[9] += " " + shared
    texts[12] = "some words " + item
    return texts + ["%% 12", "", None], item


def test_stages_against_brute_force(spark, tmp_path):
    texts, item = sample()
    rows = [(i, t, "en", f"src{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = [(i, t) for i, t in enumerate(texts) if any(c.isalpha() for c in t or "")]
    docs = [(d, dict(docs)[d]) for d, _, c in groups(docs) if d == c]
    removed = {r[0]: r for r in repeats(docs)}
    kept = {r.doc_id: r for r in corpus_pipeline.cut_repeats(
        spark, spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], SCHEMA), "").collect()}
    assert {d for d, r in removed.items() if r[2] < r[1]} <= kept.keys()
    left = [(d, r.text) for d, r in kept.items()]
    clean = {d for d, *_, bad in hits(left, [(1, item)]) if not bad}
    assert 12 not in clean and 5 not in clean and 8 in clean
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: library.encode(t) for d, t in left if d in clean}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {d: r.ids for d, r in got.items()} == want
    assert all(r.decoded == library.decode(r.ids) and r.n_tokens == len(r.ids) for r in got.values())


def test_empty_and_odd_tables(spark):
    odd = [(None, None, None, None, None), (1, None, "en", None, 3), (1, None, "en", None, 3), (2, "a" * 90, "en", "s", 90)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, SCHEMA)
        for _, stage in corpus_pipeline.STAGES[:3]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            out.collect()


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
