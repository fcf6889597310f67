"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy.

A word's hash is a polynomial over its bytes modulo 2**64, finished by a mixer;
an n-gram's hash is a polynomial over its words' hashes. Texts are worked in slices,
so the working memory is a small multiple of a slice, whatever a text's length."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_SLICE = 1 << 18
_P = 0x9E3779B97F4A7C15
_Q = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = pow(_P, -1, 1 << 64)

#: The six blanks of ASCII.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits; all other bytes belong to words.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[i for i in range(128) if not chr(i).isalnum()]] = True


class Words(NamedTuple):
    hash: np.ndarray  # uint64, in order of the texts
    text: np.ndarray  # index of the text
    start: np.ndarray  # byte offsets in the joined buffer
    end: np.ndarray
    first: np.ndarray  # for each text and one more: the index of its first word
    buffer: np.ndarray  # uint8
    offset: np.ndarray  # byte offset of each text, and the buffer's length


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POW: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _POW:
        _POW.extend((_powers(_P, _SLICE + 1), _powers(_INVERSE, _SLICE + 1)))
    return _POW[0], _POW[1]


def _long_word(a: np.ndarray) -> np.uint64:
    up, _ = _tables()
    h = np.uint64(0)
    for lo in range(0, len(a), _SLICE):
        x = a[lo : lo + _SLICE].astype(np.uint64) + np.uint64(1)
        h = h * up[len(x)] + (x * up[: len(x)][::-1]).sum(dtype=np.uint64)
    return h


def words(texts: list[str], separators: np.ndarray = BLANKS) -> Words:
    with np.errstate(over="ignore"):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        offset = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(e) + 1 for e in encoded], out=offset[1:])
        joined = b"\n".join([*encoded, b""])
        a = np.frombuffer(joined, np.uint8)
        del encoded
        up, down = _tables()
        hashes, starts, ends = [], [], []
        pos = 0
        while pos < len(a):
            hi = min(pos + _SLICE, len(a))
            sep = separators[a[pos:hi]]
            if hi < len(a) and not sep[-1]:
                cut = len(sep) - 1 - int(np.argmax(sep[::-1]))
                if not sep[cut]:  # a word of more than a slice
                    while hi < len(a) and not (more := separators[a[hi : hi + _SLICE]]).any():
                        hi += len(more)
                    hi += int(np.argmax(more)) if hi < len(a) else 0
                    hashes.append(np.array([_long_word(a[pos:hi])], np.uint64))
                    starts.append(np.array([pos]))
                    ends.append(np.array([hi]))
                    pos = hi
                    continue
                hi, sep = pos + cut + 1, sep[: cut + 1]
            edge = np.flatnonzero(np.diff(np.concatenate(([True], sep, [True])).view(np.int8)))
            s, e = edge[0::2], edge[1::2]
            if len(s):
                run = np.zeros(len(sep) + 1, np.uint64)
                np.cumsum((a[pos:hi].astype(np.uint64) + np.uint64(1)) * down[: len(sep)], out=run[1:])
                hashes.append((run[e] - run[s]) * up[e - 1])
                starts.append(s + pos)
                ends.append(e + pos)
            pos = hi
        empty = np.zeros(0, np.int64)
        start = np.concatenate(starts) if starts else empty
        end = np.concatenate(ends) if ends else empty
        h = np.concatenate(hashes) if hashes else empty.astype(np.uint64)
        h = mix(h + (end - start).astype(np.uint64) * _Q)
        first = np.searchsorted(start, offset)
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        return Words(h, text, start, end, first, a, offset)


def lower_words(texts: list[str], separators: np.ndarray) -> Words:
    """``words`` hashed in lower case, with the offsets of the texts as they are.

    Lower case can change a character's length; then the words are looked for in both forms, which have the
    same words in the same order: all that is not ASCII belongs to words, and so do letters."""
    low = [t.lower() for t in texts]
    w = words(low, separators)
    if all(t.isascii() for t in texts):
        return w
    encoded = b"\n".join([*(t.encode("utf-8", "surrogatepass") for t in texts), b""])
    a = np.frombuffer(encoded, np.uint8)
    if len(a) == len(w.buffer) and ((a & 0xC0 == 0x80) == (w.buffer & 0xC0 == 0x80)).all():
        return w
    return words(texts, separators)._replace(hash=w.hash)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that begin at each position but the last n - 1."""
    with np.errstate(over="ignore"):
        m = len(hashes) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        out = hashes[:m].copy()
        for j in range(1, n):
            out = out * _Q + hashes[j : j + m]
        return mix(out + np.uint64(n))


class Sequences:
    """Hashes of sequences of words, int64. For long n-grams: the work does not grow with their length."""

    def __init__(self, hashes: np.ndarray):
        with np.errstate(over="ignore"):
            n = len(hashes)
            up, down = _tables() if n <= _SLICE else (_powers(_P, n + 1), _powers(_INVERSE, n + 1))
            self.run, self.up = np.zeros(n + 1, np.uint64), up[: n + 1]
            np.cumsum(hashes * down[:n], out=self.run[1:])

    def ngrams(self, size: int) -> np.ndarray:
        """Those of ``size`` words that begin at each word but the last ``size - 1``."""
        with np.errstate(over="ignore"):
            total = (self.run[size:] - self.run[:-size]) * self.up[size:]
            return mix(total + np.uint64(size) * _Q).view(np.int64)

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Those from ``first`` up to, not with, ``last``."""
        with np.errstate(over="ignore"):
            total = (self.run[last] - self.run[first]) * self.up[last]
            return mix(total + (last - first).astype(np.uint64) * _Q).view(np.int64)


def shingle_sets(w: Words, n: int = 5) -> list[np.ndarray]:
    """The sorted distinct n-grams of each text. A text of fewer words has one
    shingle, all of them; a text without words has none."""
    all_grams = grams(w.hash, n)
    out = []
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if hi - lo >= n:
            x = np.sort(all_grams[lo : hi - n + 1])
            keep = np.empty(len(x), bool)
            keep[0] = True
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        else:
            out.append(grams(w.hash[lo:hi], hi - lo) if hi > lo else np.zeros(0, np.uint64))
    return out


def set_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """A hash of each set, the same whatever the order; int64."""
    with np.errstate(over="ignore"):
        sizes = np.array([len(s) for s in sets], np.int64)
        out = np.zeros(len(sets), np.uint64)
        full = sizes > 0
        if full.any():
            flat = mix(np.concatenate(sets) + _Q)
            out[full] = np.add.reduceat(flat, np.concatenate(([0], np.cumsum(sizes[full])[:-1])))
        return mix(out + sizes.astype(np.uint64)).view(np.int64)


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """MinHash band hashes of non-empty sets: int64, one row a set, one column a band."""
    with np.errstate(over="ignore"):
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * np.uint64(_P))
        keys = np.empty((len(sets), bands), np.uint64)
        for b in range(bands):
            key = np.full(len(sets), b + 1, np.uint64)
            for r in range(rows):
                k = 2 * (b * rows + r)
                x = flat * (seeds[k] | np.uint64(1)) + seeds[k + 1]
                x ^= x >> np.uint64(29)
                key = mix(key * _Q + np.minimum.reduceat(x, starts))
            keys[:, b] = key
        return keys.view(np.int64)
