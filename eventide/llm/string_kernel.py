"""The gap-weighted subsequence kernel on words, its Nyström features, and a linear SVM on them.

The kernel compares all subsequences of three letters, each weighted by DECAY to the power of the stretch it spans (at
most SPAN letters), so letters put in or left out lower a likeness but do not end it. Words are spelled in 64 symbols:
a mark for the word's two ends, a to z (look-alike digits and signs replaced), and classes of other letters. With so
few symbols the subsequences can be numbered, so once trained the landmarks and the SVM fold into one weight per
subsequence of the landmarks; no other subsequence counts.
"""

from __future__ import annotations

import re

import numpy as np

DECAY, SPAN, SYMBOLS = 0.6, 6, 64
LONGEST, STRIDE = 24, 12
_GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b < SPAN]
# Signs that stand for letters inside a word.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W\d_]+")


def units(token: str) -> list[str]:
    """The words to judge in a token without white space: its parts, and their union if marks part its letters."""
    if token.isascii() and token.isalpha():
        return _cut(token.lower())
    word = _EDGE.sub("", token.lower())
    if any(c in word for c in "0134579@$!"):
        word = word.translate(LOOKALIKES)
    parts = [p for p in _INNER.split(word) if p]
    if len(parts) > 1:
        parts.append("".join(parts))
    return [w for p in parts for w in _cut(p)]


def _cut(word: str) -> list[str]:
    """Long words as overlapping stretches, so that nothing in them is drowned."""
    if len(word) <= LONGEST:
        return [word] if word else []
    return [word[i:i + LONGEST] for i in range(0, len(word) - STRIDE, STRIDE)]


def _spelled(word: str) -> bytes:
    return bytes([0, *(ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 37 for c in word), 0])


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and weights of the subsequences of each word, a row per word; weights are scaled to a norm of one.

    A subsequence that occurs more than once stands in one column with its weights summed; unused columns weigh zero.
    """
    spelled = [_spelled(w) for w in words]
    size = max(map(len, spelled), default=3)
    codes = np.full((len(words), size + SPAN), 255, np.int64)
    for i, s in enumerate(spelled):
        codes[i, :len(s)] = np.frombuffer(s, np.uint8)
    number, weight = [], []
    for a, b in _GAPS:
        first, second, third = codes[:, :size], codes[:, a:a + size], codes[:, a + b:a + b + size]
        number.append(np.where(third == 255, -1, (first * SYMBOLS + second) * SYMBOLS + third))
        weight.append(np.full(number[-1].shape, DECAY ** (a + b + 1)))
    number, weight = np.concatenate(number, axis=1), np.concatenate(weight, axis=1)
    weight[number < 0] = 0.0
    by = np.argsort(number, axis=1, kind="stable")
    number, weight = np.take_along_axis(number, by, 1), np.take_along_axis(weight, by, 1)
    last = np.ones(number.shape, bool)
    last[:, :-1] = number[:, 1:] != number[:, :-1]
    sums = np.cumsum(weight, axis=1)
    before = np.maximum.accumulate(np.where(last, sums, 0.0), axis=1)
    total = np.where(last, sums, 0.0)
    total[:, 1:] -= np.where(last[:, 1:], before[:, :-1], 0.0)
    norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
    return np.maximum(number, 0), total / np.where(norm > 0, norm, 1.0)


class Table:
    """Rows of numbers for some subsequences; all others have a row of zeros."""

    def __init__(self, numbers: np.ndarray, rows: np.ndarray):
        self.place = np.full(SYMBOLS ** 3, len(numbers), np.int32)
        self.place[numbers] = np.arange(len(numbers))
        self.rows = np.concatenate([rows, np.zeros((1, *rows.shape[1:]))]).astype(np.float32)

    def times(self, words: list[str], step: int = 2000) -> np.ndarray:
        """Product of each word's subsequence vector with the table."""
        result = np.empty((len(words), *self.rows.shape[1:]))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(words), step):
            part = order[at:at + step]
            number, weight = subsequences([words[i] for i in part])
            place = self.place[number]
            if self.rows.ndim == 1:
                result[part] = (self.rows[place] * weight).sum(axis=1)
                continue
            sums = np.zeros((len(part), self.rows.shape[1]))
            for column in range(place.shape[1]):
                live = np.flatnonzero((place[:, column] < len(self.rows) - 1) & (weight[:, column] > 0))
                sums[live] += self.rows[place[live, column]] * weight[live, column, None]
            result[part] = sums
        return result


def gram(words: list[str]) -> tuple[np.ndarray, Table]:
    """Kernel values between words, and a table that gives any word's kernel values with them."""
    number, weight = subsequences(words)
    numbers, place = np.unique(number, return_inverse=True)
    rows = np.zeros((len(numbers), len(words)))
    np.add.at(rows, (place.reshape(number.shape), np.arange(len(words))[:, None]), weight)
    return rows.T @ rows, Table(numbers, rows)


def spread(words: list[str], most: int, alike: float = 0.85) -> list[str]:
    """The first of the words that are less alike than `alike` to all chosen before them: at most `most` landmarks."""
    likeness, chosen = gram(words)[0] if words else None, []
    for i in range(len(words)):
        if len(chosen) < most and (not chosen or likeness[i, chosen].max() < alike):
            chosen.append(i)
    return [words[i] for i in chosen]


class KernelSVM:
    """Nyström features on landmarks and a hinge-loss linear SVM, folded into one weight per subsequence."""

    def __init__(self, landmarks: list[str]):
        likeness, table = gram(landmarks)
        values, vectors = np.linalg.eigh(likeness)
        use = values > 1e-6 * values.max()
        self.map = Table(np.flatnonzero(table.place < len(table.rows) - 1),
                         table.rows[:-1] @ (vectors[:, use] / np.sqrt(values[use])))  # to Nyström features
        self.weights, self.bias = Table(np.zeros(0, np.int64), np.zeros(0)), 0.0

    def features(self, words: list[str]) -> np.ndarray:
        return self.map.times(words)

    def fit(self, positive: np.ndarray, negative: np.ndarray, weight: float = 5.0, ridge: float = 1e-4,
            rounds: int = 300) -> KernelSVM:
        """Fits on features of words. Squared hinge loss by accelerated gradient descent; a positive counts `weight` times, per class size."""
        x = np.concatenate([positive, negative])
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        cost = np.where(y > 0, weight / max(1, len(positive)), 20 / max(1, len(negative)))
        w = v = np.zeros(x.shape[1])
        rate = 1.0 / (2 * np.linalg.norm(x.T * cost @ x, 2) + ridge)
        for t in range(rounds):
            slack = np.maximum(0.0, 1 - y * (x @ v))
            new = v - rate * (ridge * v - 2 * x.T @ (cost * y * slack))
            v = new + t / (t + 3) * (new - w)
            w = new
        numbers = np.flatnonzero(self.map.place < len(self.map.rows) - 1)
        self.weights, self.bias = Table(numbers, self.map.rows[:-1] @ w[:-1]), float(w[-1])
        return self

    def margins(self, words: list[str]) -> np.ndarray:
        return self.weights.times(words) + self.bias
