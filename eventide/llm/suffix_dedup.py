"""Exact removal of long strings that also start in an earlier document, by collection BWTs.

The collection of all texts is divided by content. Every window of LENGTH bytes has a key: the least hash of the grams
in it. Equal windows have equal keys, so a stretch of windows with one key forms a short text (a segment), and only
segments of one key need to meet. Segments meet in collections whose BWT and common prefixes are built column by column
(`collection_bwt`); neighbouring rows with a common prefix of LENGTH or more are equal windows, and the smallest document
of each such group is sent back to the segments.

1. Documents are dealt to shards of some MB. Each shard reports the distinct keys of its documents.
2. Per range of keys, those found in two documents or more are flagged. All other windows are unique and end here.
3. Each shard sends one copy of each distinct segment with a flagged key. A key found in very many shards is replaced
   by hashes of longer strings around the gram, the longer the more shards have it, up to the windows themselves, so a
   frequent gram with many different surroundings does not make one large group (`Shard.parts`).
4. Per range of keys, the BWT gives each window's smallest document. Segments that share no string of half the way from
   GRAM to LENGTH bytes with another can not share a window and stay out of it.
5. Each shard marks the bytes of windows whose smallest document comes before their own.

Texts are dealt once and copies within a shard count once; what travels beside them is a small part of the text. The
flags are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import collection_bwt
from eventide.llm.tables import stored, texts_of

LENGTH, GRAM = 50, 20
SHARD_BYTES, RANGE_KEYS = 4 << 20, 1_500_000
#: Bytes of text per range of keys in step 4, and segments in one collection.
RANGE_BYTES, COLLECTION = 12 << 20, 1000
HOT_SHARDS = 1000
#: Windows in a stretch, bytes in a segment and levels of longer strings around a gram, at most.
WINDOWS = LENGTH - GRAM + 1
SEGMENT = WINDOWS + LENGTH - 1
LEVELS = (LENGTH - GRAM).bit_length()
BLOCK = 1 << 19
KEY_BITS = 56
LAST = np.iinfo(np.int64).max
_R = 0x9E3779B97F4A7C15 | 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_R, n, 1 << 64))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of the `gram` bytes from each position, by doubling."""
    doubled, size = data.astype(np.uint64) + np.uint64(1), 1
    total, done = None, 0
    while True:
        if gram & size:
            part = doubled[done:]
            total = part if total is None else total[:len(part)] * _power(size) + part
            done += size
        if size * 2 > gram:
            break
        doubled = doubled[:-size] * _power(size) + doubled[size:]
        size *= 2
    return _mixed(total[:len(data) - gram + 1])


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if width > size else values


class Shard:
    """Texts of a shard, and stretches of windows with one key: document, first window, one past the last, key."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        self.texts = texts
        self.starts = np.cumsum([0] + [len(t) for t in texts])
        self.data = b"".join(texts)
        data = np.frombuffer(self.data, np.uint8)
        fits = np.zeros(len(data) + 1, np.int64)  # windows that end inside their document
        long_ = np.flatnonzero(np.diff(self.starts) >= LENGTH)
        fits[self.starts[long_]] += 1
        fits[self.starts[long_ + 1] - LENGTH + 1] -= 1
        fits = np.cumsum(fits[:-1]) > 0
        begins, keys, last = [], [], None  # what a document's stretches are does not depend on its place in the shard
        for at in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
            least = _sliding_least(_gram_hashes(data[at:at + BLOCK + LENGTH - 1], GRAM), LENGTH - GRAM + 1)
            own = fits[at:at + len(least)]
            change = np.ones(len(least), bool)
            change[1:] = (least[1:] != least[:-1]) | (own[1:] != own[:-1])
            change[0] = last != (least[0], own[0])
            last = (least[-1], own[-1])
            heads = self.starts[np.searchsorted(self.starts, at):np.searchsorted(self.starts, at + len(least))] - at
            change[heads] = True
            first = np.flatnonzero(change)
            begins.append(first + at)
            keys.append(_mixed(least[first]) >> np.uint64(64 - KEY_BITS))  # least values crowd near zero
        begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        end = np.append(begin[1:], max(0, len(data) - LENGTH + 1))[:len(begin)]
        keep = fits[begin] if len(begin) else np.zeros(0, bool)
        begin, end, key = begin[keep], end[keep], key[keep]
        # stretches of one repeated gram can be long: cut where they outgrow a plain one
        most = WINDOWS
        pieces = (end - begin + most - 1) // most
        nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, end, key = np.repeat(begin, pieces) + nth * most, np.repeat(end, pieces), np.repeat(key, pieces)
        self.begin, self.end, self.key = begin, np.minimum(end, begin + most), key
        self.doc = np.searchsorted(self.starts, begin, side="right") - 1

    def distinct_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys in order, whether more than one document holds each, and the place of each stretch's key."""
        order = np.argsort(self.key, kind="stable")
        of, ids = self.key[order], self.ids[self.doc[order]]
        new = _new(of)
        heads = np.flatnonzero(new)
        inverse = np.empty(len(of), np.int64)
        inverse[order] = np.cumsum(new) - 1
        more = np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads) if len(heads) else np.zeros(0, bool)
        return of[heads], more, inverse

    def parts(self, of: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Stretches as parts of one name (`_names`): document, first window, one past the last, name."""
        found = []
        for at in range(0, len(of), CHUNK):
            some = of[at:at + CHUNK]
            begin, end = self.begin[some], self.end[some]
            nth, offset, name = _names(_rows(self.data, begin, end - begin + LENGTH - 1), end - begin, level)
            first = begin[nth] + offset
            last = np.append(first[1:], 0)
            closing = np.append(nth[1:] != nth[:-1], True)[:len(nth)]
            found.append((self.doc[some][nth], first, np.where(closing, end[nth], last), name))
        return tuple(np.concatenate(x) for x in zip(*found))

    def segments(self, found: np.ndarray, hot: np.ndarray, inverse: np.ndarray) -> Segments:
        """Distinct (key, text) of the stretches whose key is flagged, in order; and of each stretch the number of its
        text in that order, its document and its first window. Stretches with a hot key count part by part."""
        use = np.flatnonzero(found[inverse])
        levels = hot[inverse[use]]
        plain = use[levels == 0]
        held = [(self.doc[plain], self.begin[plain], self.end[plain], self.key[plain])]
        held += [self.parts(use[levels == k], k) for k in range(1, LEVELS + 1) if (levels == k).any()]
        doc, first, end, key = (np.concatenate(x) for x in zip(*held))
        size = end - first + LENGTH - 1
        rows = _rows(self.data, first, size)
        one, number = _numbered(key, rows, size)
        return Segments(key[one], rows[one], size[one], number, doc, first)


def _new(values: np.ndarray) -> np.ndarray:
    """Which of the values differ from the one before."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


#: Segments whose grams are looked at in one go.
CHUNK = 1 << 13
_WIDE = -(-SEGMENT // 8) * 8
_MASKS = np.frombuffer(b"".join(b"\xff" * n + bytes(_WIDE - n) for n in range(SEGMENT + 1)), np.uint64).reshape(
    SEGMENT + 1, -1)


def _rows(data: bytes, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Strings of the text as rows of 64-bit words, with zeros behind them."""
    padded = np.ndarray(len(data) + 1, f"V{_WIDE}", data + bytes(_WIDE), strides=(1,))
    return padded[begin].view(np.uint64).reshape(len(begin), _WIDE // 8) & _MASKS[size]


def _joined(rows: np.ndarray, size: np.ndarray) -> bytes:
    return rows.view(np.uint8).reshape(len(rows), _WIDE)[np.arange(_WIDE) < size[:, None]].tobytes()


def _numbered(key: np.ndarray, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct (key, string), by key and then in an order that depends on nothing but the strings; and
    the number of each place's string in that order."""
    hashed = size.astype(np.uint64)
    for word in rows.T:
        hashed = _mixed((hashed ^ word) * np.uint64(_R))
    order = np.lexsort((hashed, key))
    alike = ~(_new(key[order]) | _new(hashed[order]))
    again = np.flatnonzero(alike)
    a, b = order[again - 1], order[again]
    same = (size[a] == size[b]) & (rows[a] == rows[b]).all(axis=1)
    if not same.all():  # two strings of one hash
        order = np.lexsort((*rows.T, size, key))
        a, b = order[:-1], order[1:]
        alike = np.append(False, (key[a] == key[b]) & (size[a] == size[b]) & (rows[a] == rows[b]).all(axis=1))
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(~alike) - 1
    return order[~alike], number


def _names(rows: np.ndarray, windows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the segments' windows, where they change: segment, window in it, name.

    A name is the hash of a string around the first of the window's least grams. Each level takes half of the window's
    other bytes to it: those before, if there are so many, or else those after. So equal windows have equal names.
    """
    count, place = len(rows), np.arange(_WIDE)
    data = np.frombuffer(rows.tobytes() + bytes(LENGTH), np.uint8)
    grams = _gram_hashes(data, GRAM)[:count * _WIDE].reshape(count, _WIDE)
    inside = place < (windows + LENGTH - GRAM)[:, None]
    least = grams[:, :WINDOWS].min(axis=1)
    at = np.where((grams == least[:, None]) & inside, place, _WIDE)
    start = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :WINDOWS]
    before, rest = start - place[:WINDOWS], LENGTH - GRAM
    for _ in range(level):
        half = (rest + 1) // 2
        left = before >= half
        start, before, rest = start - half * left, before - half * left, rest - half
    inside = place[:WINDOWS] < windows[:, None]
    strings = _gram_hashes(data, LENGTH - rest)
    name = strings[np.where(inside, np.arange(count)[:, None] * _WIDE + start, 0)] >> np.uint64(64 - KEY_BITS)
    change = inside.copy()
    change[:, 1:] &= name[:, 1:] != name[:, :-1]
    nth, offset = np.nonzero(change)
    return nth, offset, name[nth, offset]


class Segments(NamedTuple):
    keys: np.ndarray
    rows: np.ndarray
    sizes: np.ndarray
    number: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers by byte significance, which compresses sorted ones well."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unplaned(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<u8").ravel()


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _shard(table: pa.Table) -> Shard:
    return Shard(table.column("doc_id").to_pylist(),
                 [t.as_py() or b"" for c in table.column("text").cast(pa.binary()).chunks for t in c])


def _table(rows: list[tuple], names: list[str], types: list) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


_KEYS = (["range", "shard", "n", "keys", "more"], [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()])
_MARKS = (["shard", "kind", "range", "n", "a", "b"],
          [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()])
_SENT = (["range", "shard", "n", "keys", "docs", "sizes", "text"], [pa.int64()] * 3 + [pa.binary()] * 4)
MARKS = "shard long, kind int, range long, n long, a binary, b binary"


def _ranges(keys: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """(range, start, stop) of sorted keys; a range is an equal part of the keys' space."""
    of = (keys >> np.uint64(KEY_BITS - 24)) * np.uint64(ranges) >> np.uint64(24)
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return [(int(of[a]), int(a), int(b)) for a, b in zip(cuts, [*cuts[1:], len(of)])]


def _report(ranges: int) -> Callable:
    """Step 1: a shard's distinct keys by range."""
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, more, _ = _shard(table).distinct_keys()
        return _table([(r, shard, b - a, _planes(keys[a:b]), _bits(more[a:b])) for r, a, b in _ranges(keys, ranges)],
                      *_KEYS)
    return run


def _flag(hot_shards: int) -> Callable:
    """Step 2: flags and levels (0: not hot) for the keys of a range, for each shard in the order of its keys."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, inverse, shards = np.unique(np.concatenate([_unplaned(r["keys"]) for r in rows]), return_inverse=True,
                                          return_counts=True)
        more = np.zeros(len(keys), bool)
        more[inverse[np.concatenate([_flags(r["more"], r["n"]) for r in rows])]] = True
        level = np.zeros(len(keys), np.uint8)
        for k in range(LEVELS):
            level += shards >= hot_shards << k
        found, hot = (more | (shards > 1))[inverse], level[inverse]
        ends = np.cumsum([r["n"] for r in rows])
        return _table([(r["shard"], 0, r["range"], r["n"], _bits(found[e - r["n"]:e]),
                        zstandard.compress(hot[e - r["n"]:e].tobytes(), 1)) for r, e in zip(rows, ends)], *_MARKS)
    return run


def _flagged(shard: Shard, marks: list[dict]) -> Segments:
    marks = sorted((m for m in marks if m["kind"] == 0), key=lambda m: m["range"])
    keys, _, inverse = shard.distinct_keys()
    found = np.concatenate([_flags(m["a"], m["n"]) for m in marks]) if marks else np.zeros(len(keys), bool)
    hot = np.frombuffer(b"".join(zstandard.decompress(m["b"]) for m in marks), np.uint8) if marks else np.zeros(
        len(keys), np.uint8)
    return shard.segments(found, hot, inverse)


def _send(ranges: int) -> Callable:
    """Step 3: a shard's distinct segments with flagged keys, each with the smallest document that holds it."""
    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        if not docs.num_rows or not marks.num_rows:
            return _table([], *_SENT)
        shard = _shard(docs)
        segments = _flagged(shard, marks.to_pylist())
        keys, sizes = segments.keys, segments.sizes
        least = np.full(len(keys), LAST)
        np.minimum.at(least, segments.number, shard.ids[segments.doc])
        text, ends = _joined(segments.rows, sizes), [0, *np.cumsum(sizes).tolist()]
        number, out = docs.column("shard")[0].as_py(), []
        for r, a, b in _ranges(keys, ranges):
            out.append((r, number, b - a, _planes(keys[a:b]), _planes(least[a:b].view(np.uint64)),
                        sizes[a:b].astype(np.uint8).tobytes(), zstandard.compress(text[ends[a]:ends[b]], 1)))
        return _table(out, *_SENT)
    return run


def _smallest(texts: list[bytes], docs: np.ndarray) -> np.ndarray:
    """Smallest document of each window of the texts, text after text; `docs` has each text's smallest document."""
    _, lcp, owner, length = collection_bwt.build(texts)
    group = np.cumsum(lcp < LENGTH) - 1
    least = np.full(int(group[-1]) + 1, LAST)
    np.minimum.at(least, group, docs[owner])
    whole = length >= LENGTH
    sizes = np.array([len(t) for t in texts], np.int64)
    before = np.cumsum(sizes - LENGTH + 1) - (sizes - LENGTH + 1)
    out = np.empty(int((sizes - LENGTH + 1).sum()), np.int64)
    out[before[owner[whole]] + sizes[owner[whole]] - length[whole]] = least[group[whole]]
    return out


def _meet(table: pa.Table) -> pa.Table:
    """Step 4: per segment of each shard, the smallest document of each of its windows."""
    blocks = table.to_pylist()
    size = np.frombuffer(b"".join(b["sizes"] for b in blocks), np.uint8).astype(np.int64)
    key = np.concatenate([_unplaned(b["keys"]) for b in blocks])
    doc = np.concatenate([_unplaned(b["docs"]) for b in blocks]).view(np.int64)
    rows = _rows(b"".join(zstandard.decompress(b["text"]) for b in blocks), np.cumsum(size) - size, size)
    one, number = _numbered(key, rows, size)
    least = np.full(len(one), LAST)
    np.minimum.at(least, number, doc)
    key, rows, size = key[one], rows[one], size[one]
    windows = size - LENGTH + 1
    begin = np.cumsum(windows) - windows
    answers = np.repeat(least, windows)  # of segments that share no window with another
    new = _new(key)
    several = np.flatnonzero(~(new & np.append(new[1:], True)))
    met = several[_may_meet(rows[several], windows[several])]
    groups = np.append(np.flatnonzero(_new(key[met])), len(met)).tolist()
    start = 0
    for stop in groups:
        if stop > start and (stop - start >= COLLECTION or stop == len(met)):
            some = met[start:stop]
            text, ends = _joined(rows[some], size[some]), np.cumsum(size[some]).tolist()
            found = _smallest([text[a:b] for a, b in zip([0, *ends], ends)], least[some])
            answers[_each(begin[some], windows[some])] = found
            start = stop
    out, at = [], 0
    for b in blocks:
        own = number[at:at + b["n"]]
        at += b["n"]
        out.append((b["shard"], 1, b["range"], b["n"],
                    _planes(answers[_each(begin[own], windows[own])].view(np.uint64)), b""))
    return _table(out, *_MARKS)


def _each(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each begin, range after range."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _may_meet(rows: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which of the segments have a window of the same first-level name as a window of another."""
    found = [_names(rows[at:at + CHUNK], windows[at:at + CHUNK], 1) for at in range(0, len(rows), CHUNK)]
    out = np.zeros(len(rows), bool)
    if found:
        nth = np.concatenate([x[0] + at * CHUNK for at, x in enumerate(found)])
        name = np.concatenate([x[2] for x in found])
        order = np.argsort(name, kind="stable")
        nth, name = nth[order], name[order]
        heads = np.flatnonzero(_new(name))
        shared = np.minimum.reduceat(nth, heads) != np.maximum.reduceat(nth, heads)
        out[nth[np.repeat(shared, np.diff(np.append(heads, len(name))))]] = True
    return out


#: Columns of other names travel with the text under this one.
CARRIED = "carried"
_DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct(
    [("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])
DONE = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"


def _mark(docs: pa.Table, marks: pa.Table) -> pa.Table:
    """Step 5: spans and remaining bytes of each document of a shard."""
    done = _marked(docs, marks) if docs.num_rows else _DONE.empty_table()
    if CARRIED not in docs.column_names:
        return done
    rows = zip(docs.column("text").cast(pa.binary()), done.column("spans"), done.column("kept"))
    texts = pa.array([kept.as_py() if not len(spans) else _whole_characters(text.as_py(), spans.as_py())
                      for text, spans, kept in rows], pa.binary())
    return done.set_column(3, "kept", texts).append_column(CARRIED, docs.column(CARRIED))


def _whole_characters(text: bytes, spans: list[dict]) -> bytes:
    """The text without its spans, each widened to the borders of the UTF-8 characters at its ends."""
    kept, at = [], 0
    for span in spans:
        start, stop = span["start"], span["stop"]
        while start > at and text[start] & 0xC0 == 0x80:
            start -= 1
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop += 1
        kept.append(text[at:max(start, at)])
        at = max(stop, at)
    return b"".join([*kept, text[at:]])


def _marked(docs: pa.Table, marks: pa.Table) -> pa.Table:
    shard, rows = _shard(docs), marks.to_pylist()
    delta = np.zeros(len(shard.data) + 1, np.int32)
    if rows:
        segments = _flagged(shard, rows)
        answers = [_unplaned(m["a"]).view(np.int64) for m in sorted((m for m in rows if m["kind"] == 1),
                                                                    key=lambda m: m["range"])]
        least = np.concatenate(answers) if answers else np.zeros(0, np.int64)
        windows = segments.sizes - LENGTH + 1
        before, size = (np.cumsum(windows) - windows)[segments.number], windows[segments.number]
        window = _each(segments.first, size)
        gone = least[_each(before, size)] < np.repeat(shard.ids[segments.doc], size)
        delta += np.bincount(window[gone], minlength=len(delta)).astype(np.int32)
        delta -= np.bincount(window[gone] + LENGTH, minlength=len(delta)).astype(np.int32)
    out = []
    covered = np.cumsum(delta[:-1]) > 0
    ids = docs.column("doc_id").to_pylist()
    for i, (start, stop) in enumerate(zip(shard.starts.tolist(), shard.starts[1:].tolist())):
        own = covered[start:stop]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]))).tolist()
        kept = np.frombuffer(shard.data, np.uint8)[start:stop][~own].tobytes() if edges else shard.texts[i]
        out.append((ids[i], stop - start, [{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2])], kept))
    return _table(out, _DONE.names, _DONE.types)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES,
                   hot_shards: int = HOT_SHARDS, carry: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, spans of bytes to remove (maximal, ascending), kept (the other bytes); with `carry`,
    also a struct `carried` of those columns, and `kept` without characters that lost a byte.

    A byte goes if it is covered by a LENGTH-byte string of the document that also starts in a document with a smaller
    id, judged on the input. A null text is empty. Rows with equal ids do not make each other go; a null id counts as
    larger than all. An empty table gives no rows.
    """
    texts, done = texts_of(docs, id_col, text_col), DONE
    if carry:
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                            F.struct(*carry).alias(CARRIED))
        done = f"{DONE}, {CARRIED} {texts.schema[CARRIED].dataType.simpleString()}"
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = 1 + size // shard_bytes
    key_ranges, text_ranges = 1 + size // 15 // RANGE_KEYS, 1 + size // RANGE_BYTES
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(shards)).cast("long"))
    marks = stored(dealt.groupBy("shard").applyInArrow(
        _report(key_ranges), "range long, shard long, n long, keys binary, more binary",
    ).groupBy("range").applyInArrow(_flag(hot_shards), MARKS), "repeat-marks")
    sent = dealt.groupBy("shard").cogroup(marks.groupBy("shard")).applyInArrow(
        _send(text_ranges), "range long, shard long, n long, keys binary, docs binary, sizes binary, text binary")
    answers = sent.groupBy("range").applyInArrow(_meet, MARKS)
    return dealt.groupBy("shard").cogroup(marks.union(answers).groupBy("shard")).applyInArrow(_mark, done)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
                    **options) -> DataFrame:
    """The table with repeated strings cut out of its texts, and its character counts renewed.

    A character of which a byte goes, goes whole. A row whose text becomes empty goes; one that was empty stays.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    cut = repeated_spans(docs, id_col, text_col, carry=others, **options)
    cut = cut.withColumn("new", F.col("kept").cast("string")).where((F.size("spans") == 0) | (F.col("new") != ""))
    made = {id_col: F.col("doc_id"), text_col: F.col("new"), chars_col: F.length("new").cast("long")}
    return cut.select(*(made.get(c, F.col(f"{CARRIED}.{c}")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def digests(docs: DataFrame, **columns) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return repeated_spans(docs, **columns).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
