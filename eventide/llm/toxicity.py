"""Toxicity of whole texts by a subsequence string-kernel SVM with Nyström landmarks.

Training sentences come from a bounded sample of labelled documents. Only documents are labelled, so a sentence of a
toxic document counts as toxic by the words that tell: those that stand in several different places in toxic sentences
and hardly ever in clean ones. They, and copies of them with letters put in, are the positive examples; words of clean
sentences are the negative ones, and the model's worst errors among all of those are added in rounds. A text scores by
its most telling word, mapped to a probability by a logistic fit on the sample.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.string_kernel import KernelSVM, spread, units
from eventide.llm.tables import batched, rows_of, stored, texts_of

FOLDS = 5
DOCS_PER_CLASS = {1: 3000, 0: 6000}
LANDMARKS, TELLING, CLEAN_WORDS, HARD_WORDS, HARD_ROUNDS = 128, 2000, 30_000, 3000, 2
CACHED_TOKENS = 500_000
_SENTENCE = re.compile(r"[.!?]+\s|\n+")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


EVIDENCE = ("largest", "top_three", "log_count", "share")


class Toxicity:
    """A trained model: SVM margins of words, and the logistic weights of a text's evidence (the last: offset)."""

    def __init__(self, svm: KernelSVM | None, weights: list[float]):
        self.svm, self.weights = svm, weights


class Judge:
    """Evidence of texts; each distinct token is judged once while it is cached."""

    FLOOR = -2.0

    def __init__(self, svm: KernelSVM | None):
        self.svm, self.known = svm, {}

    def evidence(self, texts: list[str]) -> list[tuple]:
        """EVIDENCE of each text, and its most telling token. Without words, or without a model, the least possible."""
        if self.svm is None:
            return [(self.FLOOR, self.FLOOR, 0.0, 0.0, None)] * len(texts)
        bags = [t.split() for t in texts]
        for bag, text in zip(bags, texts):
            bag.extend("".join(m.group().split()) for m in _SPACED.finditer(text))
        new = set().union(*bags) - self.known.keys()
        if len(self.known) + len(new) > CACHED_TOKENS:
            self.known, new = {}, set().union(*bags)
        self._learn(list(new))
        margin, out = self.known.__getitem__, []
        for bag in bags:
            if not bag:
                out.append((self.FLOOR, self.FLOOR, 0.0, 0.0, None))
                continue
            own = np.fromiter(map(margin, bag), np.float64, len(bag))
            top = np.sort(np.partition(own, -3)[-3:]) if len(own) > 3 else own
            high = int((own > 1).sum())
            out.append((float(own.max()), float(top.sum() + self.FLOOR * (3 - len(top))) / 3, float(np.log1p(high)),
                        high / len(own), bag[int(own.argmax())]))
        return out

    def _learn(self, tokens: list[str]) -> None:
        parts = [units(t) for t in tokens]
        words = list(set().union(*parts))
        margin = dict(zip(words, np.maximum(self.svm.margins(words), self.FLOOR).tolist()))
        for token, part in zip(tokens, parts):
            self.known[token] = max((margin[w] for w in part), default=self.FLOOR)


def _groups(batches: Iterable[pa.RecordBatch], most: int = 4 << 20) -> Iterator[list[tuple]]:
    kept, size = [], 0
    for row in rows_of(batches):
        kept.append(row)
        size += len(row[1])
        if size >= most:
            yield kept
            kept, size = [], 0
    if kept:
        yield kept


def _judged(docs: DataFrame, svm: KernelSVM | None) -> DataFrame:
    """(doc_id, EVIDENCE, worst) of texts."""
    shared = docs.sparkSession.sparkContext.broadcast(svm)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.float64()) for c in EVIDENCE), ("worst", pa.string())])

    def run(batches):
        judge = Judge(shared.value)
        rows = ((key, *found) for group in _groups(batches)
                for (key, _), found in zip(group, judge.evidence([t.decode() for _, t in group])))
        yield from batched(rows, schema)

    return docs.mapInArrow(run, f"doc_id long, {', '.join(f'{c} double' for c in EVIDENCE)}, worst string")


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _words(sample: DataFrame) -> DataFrame:
    """Per word of the sample: in how many different places (by the word before) toxic and clean sentences hold it.

    Counting places, not sentences, keeps copied passages from counting more than once.
    """
    schema = pa.schema([("word", pa.string()), ("before", pa.string()), ("toxic", pa.int32())])

    def places(batches):
        seen: set[tuple] = set()
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                for sentence in _SENTENCE.split(text or ""):
                    before = ""
                    for word in (w for token in sentence.split() for w in units(token)):
                        seen.add((word, before, toxic))
                        before = word
            if len(seen) > 500_000:
                yield from batched(seen, schema, 50_000)
                seen = set()
        yield from batched(seen, schema, 50_000)

    return sample.select("text", "toxic").mapInArrow(places, "word string, before string, toxic int").distinct().groupBy(
        "word").agg(F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).alias("n_clean"))


def _gapped(words: list[str], rng: random.Random) -> list[str]:
    """Each word with one or two letters put in at random."""
    out = []
    for word in words:
        for n in (1, 2):
            letters = list(word)
            for _ in range(n):
                letters.insert(rng.randrange(1, max(2, len(letters))), rng.choice(_LETTERS))
            out.append("".join(letters))
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: dict[int, int] | None = None, seed: int = 7) -> Toxicity:
    """Fits on at most `per_class` documents of each label, those whose ids hash lowest, outside fold 0.

    Null ids, texts and labels are not used; a document labelled twice has the larger label. Without telling words the
    model has no SVM and gives every text the same low score.
    """
    own = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    own = own.dropna().where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    size = per_class or DOCS_PER_CLASS
    chosen = own.withColumn("r", rank).where(
        ((F.col("toxic") == 1) & (F.col("r") <= size[1])) | ((F.col("toxic") == 0) & (F.col("r") <= size[0]))).drop("r")
    sample = stored(texts_of(docs, id_col, text_col).where("text is not null").join(
        F.broadcast(chosen), "doc_id"), "toxic-sample")  # chosen has no more rows than `per_class` allows
    words = stored(_words(sample).where("length(word) > 2"), "toxic-words")
    mass = words.agg(F.sum("n_toxic"), F.sum("n_clean")).first()
    if not mass[0] or not mass[1]:
        return Toxicity(None, [0.0] * len(EVIDENCE) + [-2.0])
    share = F.col("n_toxic") / (F.col("n_toxic") + F.col("n_clean") * (mass[0] / mass[1]))
    telling = [r.word for r in words.where((F.col("n_toxic") >= 5) & (share >= 0.95)).orderBy(
        F.desc("n_toxic"), "word").limit(TELLING).select("word").collect()]
    if not telling:
        return Toxicity(None, [0.0] * len(EVIDENCE) + [-2.0])
    clean = words.where((F.col("n_clean") > 0) & (share < 0.5))
    negative = [r.word for r in clean.orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS).select("word").collect()]
    common = [r.word for r in clean.orderBy(F.desc("n_clean"), "word").limit(2000).select("word").collect()]
    negative = list(dict.fromkeys(common + negative))
    marks = spread(telling[:600], LANDMARKS * 3 // 4)
    svm = KernelSVM(marks + spread(common[:300], LANDMARKS - len(marks)))
    positive = svm.features(telling + _gapped(telling, random.Random(seed)))
    known, features = set(negative), svm.features(negative)
    for _ in range(HARD_ROUNDS):
        svm.fit(positive, features)
        model = docs.sparkSession.sparkContext.broadcast(svm)

        def margins(batches, model=model):
            for batch in batches:
                found = batch.column("word").to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(model.value.margins(found))],
                                                 names=["word", "margin"])

        hard = clean.select("word").mapInArrow(margins, "word string, margin double").orderBy(
            F.desc("margin"), "word").limit(HARD_WORDS).collect()
        worst = [r.word for r in hard if r.word not in known]
        known.update(worst)
        features = np.concatenate([features, svm.features(worst)])
    svm.fit(positive, features)
    found = _judged(sample.select("doc_id", "text"), svm).join(chosen, "doc_id").select(*EVIDENCE, "toxic").toArrow()
    return Toxicity(svm, _logistic(np.stack([found.column(c).to_numpy() for c in EVIDENCE], axis=1),
                                   found.column("toxic").to_numpy()))


def _logistic(x: np.ndarray, label: np.ndarray) -> list[float]:
    """Weights and offset of a logistic map, by Newton steps with a small ridge."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (label - p) - 1e-2 * w
        w += np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), slope), -5, 5)
    return w.tolist()


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from 0.5 on), worst (the token that decided).

    A null or empty text scores as one without any telling word. Repeated rows each give a row.
    """
    judged = _judged(texts_of(docs, id_col, text_col), model.svm)
    total = sum((F.col(c) * w for c, w in zip(EVIDENCE, model.weights)), F.lit(model.weights[-1]))
    return judged.select("doc_id", (1 / (1 + F.exp(-total))).alias("score"), "worst").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
