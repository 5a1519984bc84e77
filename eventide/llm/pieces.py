"""Encoding and decoding with a SentencePiece model of merge type, through a table of last tokens.

Every prefix of a text has one encoding, so it has one last token. Going through the text, an automaton gives the
pieces that end at each position; a piece is the prefix's last token if it is compatible with the last token of the
prefix before it, that is if merging the two together gives just these two. The ids are then read backwards. The time
is linear in the text, and no merge queue is kept.

Pieces do not reach across a space that follows another character, so texts are encoded by words, and a word is
encoded once while it is cached. Words go side by side, a position at a time; a text without spaces is gone through alone,
character by character, and is not cached. Both are linear, so very long texts of either kind are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventide.llm.tables import batched, rows_of, texts_of

SPACE = "▁"
CACHED_WORDS, CACHED_PAIRS = 400_000, 2_000_000
#: Words of more characters go alone and uncached: a cached word is at most about 2 KB with its ids.
LONGEST_WORD = 64
#: Characters of cached words, whatever their number.
CACHED_CHARS = 6_000_000
#: Characters gone through side by side at most (a longer word goes alone).
CELLS = 2_000_000
#: Text whose new words are learnt together.
GROUP_BYTES = 8 << 20
_PAIR = 1 << 21


class PieceModel:
    """What encoding needs of a model file: piece ranks, ids, and each piece's last merge."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.encode(f"a{SPACE}  b ") != model.encode("a   b "):
            raise ValueError("models that normalise text are not supported")
        self.names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        own = [i for i in range(model.vocab_size()) if not (
            model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.bytes = {i: int(self.names[i][3:5], 16) for i in range(model.vocab_size()) if model.is_byte(i)}
        self.byte_ids = [0] * 256
        for i, value in self.bytes.items():
            self.byte_ids[value] = i
        self.fallback = len(self.bytes) == 256
        self.unknown, self.hidden = model.unk_id(), {i for i in range(len(self.names)) if model.is_control(i)}
        self.ids = {self.names[i]: i for i in own}
        scores = sorted({model.get_score(i) for i in own}, reverse=True)
        level = {s: r for r, s in enumerate(scores)}
        self.rank = {self.names[i]: level[model.get_score(i)] for i in own if len(self.names[i]) > 1}
        self.parts: dict[str, tuple[str, str]] = {}
        self.dead: set[str] = set()
        for name in self.rank:
            whole, last = self.merged(name)
            if len(whole) == 1:
                self.parts[name] = last
            else:
                self.dead.add(name)
        #: Pieces made of parts that rank after them, or that share their rank: their order is found by merging.
        level = [s for s, n in _count(self.rank.values()).items() if n > 1]
        self.odd = {n for n, (a, b) in self.parts.items()
                    if self.rank[n] in level or self.rank.get(a, -1) >= self.rank[n] or self.rank.get(b, -1) >= self.rank[n]}
        self.by_words = all(SPACE not in n.lstrip(SPACE) for n in self.ids)
        self.live = [n for n in self.ids if n not in self.dead]
        self.live_ids = [self.ids[n] for n in self.live]
        self.automaton = Automaton(self.live)

    def merged(self, text: str) -> tuple[list[str], tuple[str, str]]:
        """Plain merging of a short text: its tokens, and the last pair merged."""
        tokens, last = list(text), (text, "")
        while True:
            best = min(((r, i) for i in range(len(tokens) - 1)
                        if (r := self.rank.get(tokens[i] + tokens[i + 1])) is not None), default=None)
            if best is None:
                return tokens, last
            at = best[1]
            last = (tokens[at], tokens[at + 1])
            tokens[at:at + 2] = ["".join(last)]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the text a + b ends with the two tokens a, b.

        The merges that made a and b are undone, latest first. Wherever the two parts at the seam form a piece that
        would have been merged before the step undone last, the seam would not have lasted.
        """
        if a in self.odd or b in self.odd:
            return self.merged(a + b)[0] == [a, b]
        limit, rank = float("inf"), self.rank.get
        while True:
            across = rank(a + b)
            if across is not None and across < limit:
                return False
            ra, rb = rank(a, -1), rank(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, self.parts[a][1]
            else:
                limit, b = rb + 1, self.parts[b][0]


def _count(values: Iterable) -> dict:
    out: dict = {}
    for v in values:
        out[v] = out.get(v, 0) + 1
    return out


class Automaton:
    """Aho-Corasick automaton over the pieces, as arrays, so that many words are followed at once.

    `out[state]` is the longest piece that ends there, `shorter[piece]` the next shorter one that does too.
    """

    def __init__(self, names: list[str]):
        letters = sorted({ord(c) for n in names for c in n})
        self.letters = np.array(letters, np.int64)
        code = {chr(c): i for i, c in enumerate(letters)}
        self.size = np.array([len(n) for n in names], np.int64)
        children: list[dict[int, int]] = [{}]
        ends = np.full(1 + int(self.size.sum()), -1, np.int64)
        node_of = np.zeros(len(names), np.int64)
        for k, name in enumerate(names):
            at = 0
            for c in name:
                step = children[at].get(code[c])
                if step is None:
                    step = children[at][code[c]] = len(children)
                    children.append({})
                at = step
            ends[at], node_of[k] = k, at
        self.fail, self.out = np.zeros(len(children), np.int64), ends[:len(children)].copy()
        queue, above = list(children[0].values()), np.full(len(children), -1, np.int64)
        for at in queue:
            for c, child in children[at].items():
                back = int(self.fail[at])
                while back and c not in children[back]:
                    back = int(self.fail[back])
                self.fail[child] = children[back].get(c, 0)
                queue.append(child)
            above[at] = self.out[self.fail[at]]
            if self.out[at] < 0:
                self.out[at] = above[at]
        self.shorter = above[node_of]
        keys = sorted((at * len(letters) + c, child) for at, row in enumerate(children) for c, child in row.items())
        self.keys, self.next = (np.array(x, np.int64) for x in zip(*keys))

    def plain(self) -> tuple:
        """The same automaton for one character at a time: letter numbers, steps by key, and the arrays as lists."""
        return ({chr(c): i for i, c in enumerate(self.letters.tolist())}, dict(zip(self.keys.tolist(), self.next.tolist())),
                *(x.tolist() for x in (self.fail, self.out, self.size, self.shorter)))

    def codes(self, chars: np.ndarray) -> np.ndarray:
        """Letter numbers of code points; -1 for those in no piece."""
        at = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        return np.where(self.letters[at] == chars, at, -1)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        state, open_ = np.where(code < 0, 0, state), np.flatnonzero(code >= 0)
        while len(open_):
            key = state[open_] * len(self.letters) + code[open_]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            state[open_[hit]] = self.next[at[hit]]
            open_ = open_[~hit]
            open_ = open_[state[open_] > 0]
            state[open_] = self.fail[state[open_]]
        return state


class PieceCoder:
    """Encodes and decodes; keeps caches, so make one per task."""

    def __init__(self, model: PieceModel):
        self.model, self.auto = model, model.automaton
        self.live = len(model.live)
        self.keys, self.good = np.zeros(0, np.int64), np.zeros(0, bool)
        self.words: dict[str, tuple] = {}
        self.held = 0  # characters of the words
        self.plain: tuple = ()
        self.pairs: dict[int, bool] = {}

    def _spelled(self, token: int) -> str:
        return self.model.live[token] if token < self.live else chr(token - self.live)

    def _compatible(self, keys: np.ndarray, fresh: dict[int, bool]) -> np.ndarray:
        """Whether each pair of tokens, as a key, may stand side by side; `fresh` gets the pairs met first."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        out = np.zeros(len(keys), bool)
        out[known] = self.good[at[known]]
        if not known.all():
            some, back = np.unique(keys[~known], return_inverse=True)
            for key in some.tolist():
                if key not in fresh:
                    fresh[key] = self.model.compatible(*map(self._spelled, divmod(key, _PAIR)))
            out[~known] = np.array([fresh[k] for k in some.tolist()], bool)[back]
        return out

    def tokens(self, texts: list[str]) -> list[list[int]]:
        """Token numbers of texts whose spaces are `SPACE`; characters that no piece spells are numbered after pieces.

        The texts are gone through side by side, one position at a time.
        """
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        sizes = np.array([len(texts[i]) for i in order], np.int64)
        wide, high = (int(sizes[0]) if len(order) else 0), len(order)
        chars = np.zeros((high, wide), np.int64)
        flat = np.frombuffer("".join(texts[i] for i in order).encode("utf-32-le"), "<u4")
        chars[np.arange(wide) < sizes[:, None]] = flat
        codes = self.auto.codes(chars)
        last = np.zeros((high, wide + 1), np.int64)
        state, fresh = np.zeros(high, np.int64), {}
        for end in range(1, wide + 1):
            rows = np.arange(np.searchsorted(-sizes, -end, side="right"))
            state = self.auto.step(state[:len(rows)], codes[:len(rows), end - 1])
            token = self.auto.out[state]
            while len(rows):
                none = token < 0
                last[rows[none], end] = self.live + chars[rows[none], end - 1]
                rows, token = rows[~none], token[~none]
                start = end - self.auto.size[token]
                good = start == 0
                inner = np.flatnonzero(~good)
                good[inner] = self._compatible(last[rows[inner], start[inner]] * _PAIR + token[inner], fresh)
                last[rows[good], end] = token[good]
                rows, token = rows[~good], self.auto.shorter[token[~good]]
        self._remember(fresh)
        return self._backwards(last, sizes, order)

    def tokens_alone(self, text: str) -> list[int]:
        """Token numbers of one text, as `tokens` gives them, one character after the other."""
        self.plain = self.plain or self.auto.plain()
        letter, go, fail, out, size, shorter = self.plain
        if len(self.pairs) > CACHED_PAIRS // 4:
            self.pairs = {}
        letters, live, pairs, state, last = len(letter), self.live, self.pairs, 0, [0]
        for end, char in enumerate(text, 1):
            code = letter.get(char)
            if code is None:
                state = 0
            else:
                while (to := go.get(state * letters + code)) is None and state:
                    state = fail[state]
                state = to or 0
            token = out[state]
            while token >= 0 and (start := end - size[token]):
                key = last[start] * _PAIR + token
                good = pairs.get(key)
                if good is None:
                    good = pairs[key] = self.model.compatible(self._spelled(last[start]), self._spelled(token))
                if good:
                    break
                token = shorter[token]
            last.append(token if token >= 0 else live + ord(char))
        found, at = [], len(text)
        while at:
            found.append(last[at])
            at -= size[last[at]] if last[at] < live else 1
        return found[::-1]

    def _remember(self, fresh: dict[int, bool]) -> None:
        if fresh:
            if len(self.keys) + len(fresh) > CACHED_PAIRS:
                self.keys, self.good = self.keys[:0], self.good[:0]
            keys = np.concatenate([self.keys, np.fromiter(fresh, np.int64, len(fresh))])
            good = np.concatenate([self.good, np.fromiter(fresh.values(), bool, len(fresh))])
            by = np.argsort(keys, kind="stable")
            self.keys, self.good = keys[by], good[by]

    def _backwards(self, last: np.ndarray, sizes: np.ndarray, order: list[int]) -> list[list[int]]:
        rows, at, found = np.arange(len(sizes)), sizes.copy(), []
        width = np.append(self.auto.size, 1)
        while len(rows := rows[at[rows] > 0]):
            token = last[rows, at[rows]]
            found.append((rows, token))
            at[rows] -= width[np.minimum(token, self.live)]
        out: list[list[int]] = [[] for _ in order]
        if found:
            rows, token = (np.concatenate(x[::-1]) for x in zip(*found))
            by = np.argsort(rows, kind="stable")
            cuts = np.cumsum(np.bincount(rows, minlength=len(order)))
            token, start = token[by].tolist(), 0
            for row, stop in enumerate(cuts.tolist()):
                out[order[row]] = token[start:stop]
                start = stop
        return out

    def _ids(self, tokens: list[int]) -> list[int]:
        ids = self.model.live_ids
        try:
            return [ids[t] for t in tokens]
        except IndexError:
            out: list[int] = []
            for t in tokens:
                if t < self.live:
                    out.append(ids[t])
                elif self.model.fallback:
                    out.extend(self.model.byte_ids[b] for b in chr(t - self.live).encode())
                else:
                    out.append(self.model.unknown)
            return out

    def learn(self, chunks: Iterable[str]) -> dict[str, tuple]:
        """Chunk to (number of ids, ids, ids in decimal, decoded bytes), for chunks that no token leaves."""
        wanted = set(chunks)
        known, new = self.words, [c for c in wanted if c not in self.words]
        chars = sum(map(len, new))
        if len(known) + len(new) > CACHED_WORDS or self.held + chars > CACHED_CHARS:
            new, self.held = list(wanted), 0
            known = self.words = {}
            chars = sum(map(len, new))
        self.held += chars
        new.sort(key=len)
        at = 0
        while at < len(new):
            stop = at + 1
            if len(new[at]) > LONGEST_WORD:
                known[new[at]] = self._coded(self.tokens_alone(new[at]))
                at = stop
                continue
            while stop < len(new) and len(new[stop]) <= LONGEST_WORD and (stop - at + 1) * len(new[stop]) <= CELLS:
                stop += 1
            part = new[at:stop]
            for chunk, tokens in zip(part, self.tokens(part)):
                known[chunk] = self._coded(tokens)
            at = stop
        return known

    def _coded(self, tokens: list[int]) -> tuple:
        ids = self._ids(tokens)
        return len(ids), ids, ",".join(map(str, ids)).encode(), self._bytes(ids)

    def chunks(self, text: str) -> list[str]:
        """The text after its leading space is added, cut where a word begins."""
        if not text:
            return []
        if not self.model.by_words:
            return [SPACE + text.replace(" ", SPACE)]
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))
        return [SPACE + w for w in text.split(" ")]

    def coded(self, texts: list[str]) -> list[list[tuple]]:
        split = [self.chunks(t) for t in texts]
        word = self.learn(c for cs in split for c in cs).__getitem__
        out = [[word(c) for c in cs] for cs in split]
        long = {c for cs in split for c in cs if len(c) > LONGEST_WORD}
        for c in long:
            del self.words[c]
        self.held -= sum(map(len, long))
        return out

    def encode(self, text: str) -> list[int]:
        return [i for w in self.coded([text])[0] for i in w[1]]

    def _bytes(self, ids: Iterable[int]) -> bytes:
        """Pieces and byte tokens spelled out, with spaces, before byte runs are read as UTF-8."""
        model, out = self.model, []
        for i in ids:
            if i in model.bytes:
                out.append(bytes([model.bytes[i]]))
            elif i == model.unknown:
                out.append(" ⁇ ".encode())
            elif i not in model.hidden:
                out.append(model.names[i].replace(SPACE, " ").encode())
        return b"".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        return self.joined([self._bytes(ids)]).decode()

    @staticmethod
    def joined(parts: Iterable[bytes]) -> bytes:
        """Decoded text of spelled-out words: without the added space; bytes that spell no character become U+FFFD."""
        whole = b"".join(parts)
        return whole[1:] if whole[:1] == b" " else whole.decode(errors="replace").encode() if whole else whole


def _coded_rows(batches, coder: PieceCoder) -> Iterator[tuple]:
    """(doc_id, coded words) of each row; words new to the cache are learnt for many rows at once."""
    for rows in _groups(rows_of(batches), GROUP_BYTES):
        for (key, _), words in zip(rows, coder.coded([text.decode() for _, text in rows])):
            yield key, words


def _groups(rows: Iterable[tuple], most: int) -> Iterator[list[tuple]]:
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += len(row[1])
        if size >= most:
            yield kept
            kept, size = [], 0
    if kept:
        yield kept


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (array<int>), decoded (string). A null text is empty and has no ids."""
    model = docs.sparkSession.sparkContext.broadcast(PieceModel(path))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches):
        coder = PieceCoder(model.value)
        rows = ((key, [i for w in words for i in w[1]], coder.joined(w[3] for w in words).decode())
                for key, words in _coded_rows(batches, coder))
        yield from batched(rows, schema, 200)

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, taken from what `encode` gives, inside the task."""
    model = docs.sparkSession.sparkContext.broadcast(PieceModel(path))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batches):
        coder = PieceCoder(model.value)
        rows = ((key, sum(w[0] for w in words), hashlib.sha256(b",".join([w[2] for w in words])).hexdigest(),
                 hashlib.sha256(coder.joined([w[3] for w in words])).hexdigest())
                for key, words in _coded_rows(batches, coder))
        yield from batched(rows, schema)

    return texts_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
