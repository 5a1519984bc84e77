"""License scans: ordered signature rules over whole texts, gated by keywords, overlaps resolved by containment."""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.license_rules import BASE, Rule, rules
from eventide.llm.tables import batched, rows_of, texts_of
from eventide.llm.words import words_of

SCANNED = ("doc_id long, n_words long, base array<struct<label:string,start:long>>, "
           "found array<struct<label:string,priority:int,weight:double,start:long,stop:long,kept:boolean>>")


class Scanner:
    """Base phrases and rules, with the keywords that open them."""

    def __init__(self, base: list[tuple[str, str]], extra: list[Rule]):
        self.base = [(label, [w.encode() for w in phrase.split()]) for label, phrase in base]
        self.rules = [(r, frozenset(k.encode() for k in r.keywords)) for r in extra]
        self.triggers = frozenset().union(*(k for _, k in self.rules), *(w for _, w in self.base))

    def scan(self, text: bytes) -> tuple[int, list[tuple], list[tuple]]:
        """(number of words, base places, detections) of a text; places are word numbers, from 0."""
        words = words_of(text)
        held = self.triggers.intersection(words)
        open_ = [r for r, keys in self.rules if keys <= held]
        base = [b for b in self.base if held.issuperset(b[1])]
        if not open_ and not base:
            return len(words), [], []
        joined = b" ".join(words)
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        places = []
        for label, phrase in base:
            whole, at = b" ".join(phrase), -1
            while (at := joined.find(whole, at + 1)) >= 0:
                place = bisect_left(starts, at)
                if starts[place] == at and words[place:place + len(phrase)] == phrase:
                    places.append((label, place))
        found = [(r.label, r.priority, r.weight, bisect_left(starts, m.start()), bisect_left(starts, m.end()))
                 for r in open_ for m in r.pattern.finditer(joined)]
        return len(words), sorted(places, key=lambda p: (p[1], p[0])), suppressed(found)


def suppressed(found: list[tuple]) -> list[tuple]:
    """Detections (label, priority, weight, start, stop) in order of place, with whether each is kept.

    One is not kept if its words lie within those of another whose priority is not lower. Of detections of the same
    words the higher priority stays, then the earlier rule's.
    """
    reach: dict[int, int] = {}
    out = []
    for label, priority, weight, start, stop in sorted(found, key=lambda d: (d[3], -d[4], -d[1])):
        kept = all(end < stop for p, end in reach.items() if p >= priority)
        out.append((label, priority, weight, start, stop, kept))
        reach[priority] = max(stop, reach.get(priority, -1))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         base: list[tuple[str, str]] | None = None, extra: list[Rule] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, base places, and every detection with whether it is kept. A null text is empty."""
    scanner = Scanner(BASE if base is None else base, rules() if extra is None else extra)
    one = pa.struct([("label", pa.string()), ("start", pa.int64())])
    hit = pa.struct([("label", pa.string()), ("priority", pa.int32()), ("weight", pa.float64()),
                     ("start", pa.int64()), ("stop", pa.int64()), ("kept", pa.bool_())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(one)),
                        ("found", pa.list_(hit))])

    def rows(batches):
        for key, text in rows_of(batches):
            n, places, found = scanner.scan(text)
            yield (key, n, [dict(zip(("label", "start"), p)) for p in places],
                   [dict(zip(("label", "priority", "weight", "start", "stop", "kept"), d)) for d in found])

    return texts_of(docs, id_col, text_col).mapInArrow(lambda b: batched(rows(b), schema), SCANNED)


def _named(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def summary(docs: DataFrame, **columns) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_found, n_suppressed.

    `labels` holds the base labels and those of kept detections. `score` is the chance that at least one kept
    detection is right, their weights being taken as independent; a base place counts 0.9.
    """
    kept = F.filter("found", lambda d: d["kept"])
    base = F.transform("base", lambda b: b["label"])
    starts = F.transform("base", lambda b: b["start"])
    wrong = F.aggregate(kept, F.when(F.size("base") > 0, 0.1).otherwise(1.0), lambda a, d: a * (1 - d["weight"]))
    return scan(docs, **columns).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), _named(base).alias("base_labels"),
        _named(F.concat(base, F.transform(kept, lambda d: d["label"]))).alias("labels"),
        (1 - wrong).alias("score"), F.size("found").cast("long").alias("n_found"),
        (F.size("found") - F.size(kept)).cast("long").alias("n_suppressed"))
