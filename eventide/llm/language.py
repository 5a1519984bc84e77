"""Language identification by Bayesian fusion of four kinds of evidence.

The posterior of a language is proportional to

    prior(language | host) * P(text | language) * P(declared | language) * P(address suffix | language)

The text likelihood is a byte n-gram model fitted on labelled texts. The other tables come from grouped aggregation
over the whole table, each row counting towards the languages as its text alone suggests. A host's prior is smoothed
towards its domain's, that towards its suffix's, and that towards the whole table's. A row's own count is taken out of
its prior, so that it is not heard twice.

The posterior only compares the known languages with one another. Whether a text is in any of them is told by its fit:
the mean log likelihood of its n-grams over that of a model in which all n-grams are alike. It does not grow with the
text's length. Each language's least fit comes from the labelled sample, each text of it judged without its own counts.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.tables import stored

NGRAM, BUCKETS = 4, 1 << 18
#: Neighbouring n-grams overlap, so each counts as this share of an independent observation.
TEXT_WEIGHT = 0.25
SHRINK = 5.0
SAMPLE_PER_LANGUAGE = 1000
MIN_POSTERIOR = 0.6
#: A language's usual fit is that of all but this share of its sample; its least fit lies halfway down to that of a
#: text without any known n-gram.
ODD_SHARE = 0.05
_SPACED = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_ZEROS, _LONG_NUMBER = re.compile("&#0+(?=[0-9])"), re.compile("&#[0-9]{8,}")
_RAW = re.compile(r"<(script|style)\b", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}


def _grams(text: bytes) -> np.ndarray:
    """Bucket of every n-gram of the letters of a text; words are parted by one space."""
    data = np.frombuffer(b" " + b" ".join(text.translate(_SPACED).split()) + b" ", np.uint8).astype(np.uint32)
    if len(data) < NGRAM:
        return np.zeros(0, np.int64)
    out = np.zeros(len(data) - NGRAM + 1, np.uint32)
    for i in range(NGRAM):
        out = out * np.uint32(0x01000193) + data[i:len(data) - NGRAM + 1 + i]
    return ((out * np.uint32(0x9E3779B1)) >> np.uint32(32 - 18)).astype(np.int64)


def visible_text(page: bytes) -> bytes:
    """A page's text without scripts, styles, comments and tags. What is never closed counts as a tag, or as text where
    that is not closed either. Each kind of end is looked for once more only where one has been found, so any page takes
    time in proportion to its length."""
    text, out, at = page.decode(), [], 0
    missing: set[str] = set()
    while True:
        start = text.find("<", at)
        if start < 0 or "tag" in missing:
            out.append(text[at:])
            break
        out.append(text[at:start])
        end = -1
        raw = _RAW.match(text, start)
        if raw and raw[1].lower() not in missing:
            closing = _RAW_END[raw[1].lower()].search(text, raw.end())
            end = closing.end() if closing else -1
            if not closing:
                missing.add(raw[1].lower())
        elif text.startswith("<!--", start) and "comment" not in missing:
            end = text.find("-->", start + 4) + 3
            if end < 3:
                end = -1
                missing.add("comment")
        if end < 0:
            end = text.find(">", start) + 1
        if not end:
            missing.add("tag")
            at = start
            out.append("")
            continue
        out.append(" ")
        at = end
    return _unescaped("".join(out)).encode("utf-8", "replace")


def _unescaped(text: str) -> str:
    """Numbers too long for any character are cut, as the regular decoding fails on thousands of digits."""
    return entities.unescape(_LONG_NUMBER.sub("&#9999999", _ZEROS.sub("&#", text)) if "&#" in text else text)


class TextModel:
    """Log likelihood of each n-gram bucket under each language.

    `limits` has the highest id hash in each language's sample. `least` and `mean` are the fits of `judge`.
    """

    def __init__(self, languages: list[str], counts: np.ndarray, alpha: float = 0.05,
                 limits: dict[str, int] | None = None):
        self.languages, self.counts, self.alpha, self.limits = languages, counts, alpha, limits or {}
        smooth = counts + alpha
        self.table = np.log(smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32)
        self.least, self.mean = np.full(len(languages), -np.inf), np.zeros(len(languages))

    def score(self, text: bytes) -> np.ndarray:
        grams = _grams(text)
        out = np.zeros(len(self.languages))
        for at in range(0, len(grams), 1 << 18):
            out += self.table[grams[at:at + (1 << 18)]].sum(axis=0, dtype=np.float64)
        return out * TEXT_WEIGHT

    def fit(self, text: bytes, sampled: str | None = None) -> tuple[int, np.ndarray]:
        """Number of n-grams, and their mean log likelihood under each language over that under equal chances.

        `sampled` is the language in whose sample the text is; its own counts are taken out there.
        """
        grams = _grams(text)
        buckets, times = np.unique(grams, return_counts=True)
        logs = self.table[buckets].astype(np.float64)
        if sampled in self.languages:
            at = self.languages.index(sampled)
            left = np.maximum(self.counts[buckets, at] - times, 0) + self.alpha
            whole = max(self.counts[:, at].sum() - len(grams), 0) + self.alpha * BUCKETS
            logs[:, at] = np.log(left / whole)
        return len(grams), times @ logs / max(len(grams), 1) + np.log(BUCKETS)

    def judge(self, usual: dict[str, tuple[float, float]]) -> None:
        """Sets each language's least fit from the usual and the mean fit of its sample."""
        none = np.log(self.alpha * BUCKETS / (self.counts.sum(axis=0) + self.alpha * BUCKETS))
        for at, language in enumerate(self.languages):
            low, self.mean[at] = usual.get(language, (-np.inf, 0.0))
            self.least[at] = (none[at] + low) / 2

    def known(self, text: bytes, sampled: str | None = None) -> bool:
        """Whether a text's fit reaches the least fit of any language.

        One independent observation of the language's mean fit is added, so that a few letters decide nothing.
        """
        n, fits = self.fit(text, sampled)
        free = 1 / TEXT_WEIGHT
        return bool(((n * fits + free * self.mean) / (n + free) >= self.least).any())


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
          per_language: int = SAMPLE_PER_LANGUAGE) -> TextModel:
    """Fits the text model on at most `per_language` rows of each language, those whose ids hash lowest
    (with repeated ids, all their rows).

    Rows with a null id, text or label are not used. The counts, not the texts, come to the driver: their number is
    bounded by the model's size. One hash limit and two fits per language come to the driver too.
    """
    rows = labelled.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("string").alias("l"),
                           F.col(text_col).cast("string").alias("t")).dropna()
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h"))
    hashed = rows.withColumn("h", F.xxhash64("i"))
    limits = {r.l: r.h for r in hashed.select("l", "h").withColumn("r", rank).where(
        F.col("r") <= per_language).groupBy("l").agg(F.max("h").alias("h")).collect()}
    if not limits:
        return TextModel([], np.zeros((BUCKETS, 0)))
    limit = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))
    chosen = hashed.where(F.col("h") <= F.element_at(limit, F.col("l"))).select("l", "t")
    schema = pa.schema([("l", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch.column("l").to_pylist(), batch.column("t").cast(pa.binary())):
                if label not in seen:
                    seen[label] = np.zeros(BUCKETS, np.int64)
                seen[label] += np.bincount(_grams(text.as_py()), minlength=BUCKETS)
        for label, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at)), pa.array(at), pa.array(counts[at])],
                                             schema=schema)

    sums = chosen.mapInArrow(count, "l string, bucket long, n long").groupBy("l", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    languages = sorted(set(sums.column("l").to_pylist()))
    counts = np.zeros((BUCKETS, len(languages)))
    column = np.array([languages.index(x) for x in sums.column("l").to_pylist()], np.int64)
    counts[sums.column("bucket").to_numpy(), column] = sums.column("n").to_numpy()
    model = TextModel(languages, counts, limits=limits)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def fits(batches) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            labels, found = batch.column("l").to_pylist(), []
            for label, text in zip(labels, batch.column("t").cast(pa.binary())):
                n, fit = model.fit(text.as_py(), label)
                found.append(float(fit[model.languages.index(label)]) if n else None)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(found, pa.float64())],
                                             names=["l", "fit"])

    lettered = chosen.where(F.col("l").isin(languages))
    model.judge({r.l: (r.low, r.mean) for r in lettered.mapInArrow(fits, "l string, fit double").dropna().groupBy(
        "l").agg(F.percentile_approx("fit", ODD_SHARE).alias("low"), F.avg("fit").alias("mean")).collect()})
    return model


def _score(rows: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    """Adds text_scores, n_letters and known to (id, text, declared, host, domain, suffix, sampled), and drops the text
    and sampled."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = ["id", "declared", "host", "domain", "suffix"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.binary())]
            texts = [visible_text(t) for t in texts] if markup else texts
            letters = [len(b"".join(t.translate(_SPACED).split())) for t in texts]
            scores = [model.score(t) if n else np.zeros(len(model.languages)) for t, n in zip(texts, letters)]
            known = [n > 0 and model.known(t, s) for t, n, s in zip(texts, letters, batch.column("sampled").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.list_(pa.float64())), pa.array(letters, pa.int64()),
                 pa.array(known, pa.bool_())],
                names=[*kept, "text_scores", "n_letters", "known"])

    return rows.select(*kept, "sampled", "text").mapInArrow(
        run, "id long, declared string, host string, domain string, suffix string, text_scores array<double>, "
        "n_letters long, known boolean")


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def _sums(rows: DataFrame, key: str, k: int, name: str) -> DataFrame:
    """Per key: how much its rows count towards each language."""
    return rows.where(f"{key} is not null").groupBy(F.col(key).alias(f"{key}_key")).agg(
        F.array(*(F.sum(F.col("alone")[i]) for i in range(k))).alias(name))


def identify(rows: DataFrame, model: TextModel, id_col: str, text_col: str, declared_col: str | Column | None = None,
             host_col: str | Column | None = None, domain_col: str | Column | None = None,
             suffix_col: str | Column | None = None, markup: bool = False,
             min_posterior: float = MIN_POSTERIOR, label_col: str | Column | None = None) -> DataFrame:
    """Per row: id, lang, posterior, text_lang, declared, rejected.

    Columns that are not given, or are null in a row, say nothing. A row is rejected if its text has no letters, fits
    no language, or no language reaches `min_posterior`. If `rows` are those the model was trained on, `label_col` is
    their label: the fit of a row of the sample is then taken without its own counts. Rows with equal ids are judged each by itself. A model without languages
    rejects every row, with a null language. Ties go to the language that sorts first.
    """
    def given(col: str | Column | None) -> Column:
        return F.lit(None).cast("string") if col is None else (F.col(col) if isinstance(col, str) else col).cast("string")

    k, languages = len(model.languages), model.languages
    named = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.lower(given(declared_col)).alias("declared"), given(host_col).alias("host"),
                        given(domain_col).alias("domain"), given(suffix_col).alias("suffix"),
                        given(label_col).alias("label"))
    if model.limits:
        limit = F.element_at(F.create_map(*(F.lit(x) for pair in model.limits.items() for x in pair)), F.col("label"))
        named = named.withColumn("sampled", F.when(F.col("id").isNotNull() & (F.xxhash64("id") <= limit), F.col("label")))
    else:
        named = named.withColumn("sampled", F.lit(None).cast("string"))
    scored = _score(named, model, markup)
    if not k:
        none = F.lit(None).cast("string")
        return scored.select("id", none.alias("lang"), F.lit(0.0).alias("posterior"), none.alias("text_lang"),
                             "declared", F.lit(True).alias("rejected"))
    scored = stored(scored, "language").withColumn(
        "alone", F.when(F.col("n_letters") > 0, _softmax(F.col("text_scores"))).otherwise(
            F.array(*[F.lit(0.0)] * k)))
    total = scored.agg(*(F.coalesce(F.sum(F.col("alone")[i]), F.lit(0.0)) for i in range(k))).first()
    whole = [(t + 1.0) / (sum(total) + k) for t in total]
    joined = scored
    for key, name in (("host", "by_host"), ("domain", "by_domain"), ("suffix", "by_suffix"), ("declared", "by_declared")):
        joined = joined.join(_sums(scored, key, k, name), F.col(key) == F.col(f"{key}_key"), "left")

    def smoothed(name: str, above: list[Column]) -> list[Column]:
        """Shares of a group without the row itself, drawn towards the shares above it."""
        own = [F.greatest(F.lit(0.0), F.coalesce(F.col(name)[i] - F.col("alone")[i], F.lit(0.0))) for i in range(k)]
        size = reduce(lambda a, b: a + b, own)
        return [(n + SHRINK * up) / (size + SHRINK) for n, up in zip(own, above)]

    def likelihood(name: str) -> list[Column]:
        """Log chance of the row's value under each language; nothing known counts alike for all."""
        return [F.coalesce(F.log((F.col(name)[i] + 0.5) / (F.lit(total[i]) + 1.0)), F.lit(0.0)) for i in range(k)]

    prior = smoothed("by_host", smoothed("by_domain", smoothed("by_suffix", [F.lit(w) for w in whole])))
    declared, suffix = likelihood("by_declared"), likelihood("by_suffix")
    fused = _softmax(F.array(*(F.log(prior[i]) + F.col("text_scores")[i] + declared[i] + suffix[i] for i in range(k))))
    names = F.array(*map(F.lit, languages))
    best = F.array_max("fused")
    return joined.withColumn("fused", fused).select(
        "id", names[F.array_position("fused", best).cast("int") - 1].alias("lang"), best.alias("posterior"),
        F.when(F.col("n_letters") > 0, names[F.array_position("text_scores", F.array_max("text_scores")).cast("int") - 1]
               ).alias("text_lang"), "declared",
        ((F.col("n_letters") == 0) | ~F.col("known") | (best < min_posterior)).alias("rejected"))


def identify_pages(pages: DataFrame, model: TextModel, id_col: str = "page_id", html_col: str = "html",
                   url_col: str = "url") -> DataFrame:
    """`identify` for web pages: declared by the html element's lang, host and suffix from the address.

    The suffix is the host's last label with the address's first path part, where that has two letters.
    """
    declared = F.regexp_extract(html_col, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)
    host = F.regexp_extract(F.lower(url_col), r"^[a-z]+://([^/:?#]+)", 1)
    part = F.regexp_extract(F.lower(url_col), r"^[a-z]+://[^/?#]+/([a-z]{2})(?:[/?#]|$)", 1)
    ends = F.substring_index(host, ".", -1)
    none = lambda c: F.when(c != "", c)
    return identify(pages, model, id_col, html_col, none(declared), none(host), none(F.substring_index(host, ".", -2)),
                    none(F.when(host != "", F.concat_ws("/", ends, none(part))).otherwise("")), markup=True)
