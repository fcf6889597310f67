"""Statistics of whole texts that the quality rules and the quality classifier share."""

from __future__ import annotations

import numpy as np

from netfeat.llm import kernel

WINDOW = 8
LOWER, UPPER, DIGIT, BLANK, NEWLINE, STOP, SYMBOL, OTHER_ASCII, FOREIGN = range(9)
CLASSES = 9
SYMBOLS = b"#*$%&|<>"

#: Class of a byte: code points outside ASCII count by their first byte, CLASSES marks the rest.
_CLASS = np.full(256, CLASSES, np.int64)
_CLASS[:128] = OTHER_ASCII
_CLASS[ord("a") : ord("z") + 1] = LOWER
_CLASS[ord("A") : ord("Z") + 1] = UPPER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
_CLASS[0x0A] = NEWLINE
_CLASS[list(b".,;:!?'\"()-")] = STOP
_CLASS[list(SYMBOLS)] = SYMBOL
_CLASS[0xC0:] = FOREIGN

#: fixed values: common words of each language, and their order in the histograms
COMMON_WORDS = {
    "en": "the of and to in is that it was for on are as with be this by from or an at not".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus au sur ne se ce il elle".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo es como más".split(),
}
# end of fixed values
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})


def _vocabulary_hashes() -> tuple[np.ndarray, np.ndarray]:
    h = kernel.words([" ".join(VOCABULARY)]).hash
    order = np.argsort(h)
    return h[order], order


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    return np.isin(keys, twice) if len(twice) else np.zeros(len(keys), bool)


def per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, weights=values, minlength=n).astype(np.int64) if len(values) else np.zeros(n, np.int64)


class TextStats:
    """Arrays with one entry for each text; words are runs of bytes that are no ASCII blank."""

    def __init__(self, texts: list[str]):
        n = len(texts)
        w = self.words = kernel.words(texts)
        size = np.diff(w.offset)
        owner = np.repeat(np.arange(n), size)
        with np.errstate(over="ignore"):
            salt = kernel.mix(w.text.astype(np.uint64) + np.uint64(1))
        self.n_words = np.diff(w.first)
        self.characters = np.bincount(owner * (CLASSES + 1) + _CLASS[w.buffer], minlength=n * (CLASSES + 1)).reshape(n, -1)[:, :CLASSES]
        self.characters[:, NEWLINE] -= 1  # the end that joins the texts
        head = (w.buffer & 0xC0) != 0x80
        points = np.concatenate(([0], np.cumsum(head)))
        self.word_points = points[w.end] - points[w.start]
        self.word_chars = per_text(self.word_points, w.text, n)
        self.n_symbols = self.characters[:, SYMBOL]
        self._lines(texts)
        # words in windows of eight that the text holds twice or more
        grams = kernel.grams(w.hash, WINDOW)
        inside = w.text[: len(grams)] == w.text[WINDOW - 1 :] if len(grams) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        hit = at[repeated(grams[at] ^ salt[at])]
        cover = np.zeros(len(w.hash) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        self.n_repeat_words = per_text(np.cumsum(cover[:-1]) > 0, w.text, n)
        # different words, and how often the vocabulary's words occur in lower case
        self.n_different = per_text(np.ones(0), np.zeros(0, np.int64), n)
        if len(w.hash):
            order = np.argsort(w.hash ^ salt, kind="stable")
            key = (w.hash ^ salt)[order]
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            self.n_different = per_text(fresh, w.text[order], n)

    def _lines(self, texts: list[str]) -> None:
        duplicate, filled, short = [], [], []
        for t in texts:
            seen, d, f, s = set(), 0, 0, 0
            for line in t.split("\n"):
                if line.strip(" \t\x0b\x0c\r"):
                    f += 1
                    s += len(line) < 30
                    if line in seen:
                        d += 1
                    else:
                        seen.add(line)
            duplicate.append(d)
            filled.append(f)
            short.append(s)
        self.n_dup_lines, self.n_lines, self.n_short_lines = map(np.array, (duplicate, filled, short))

    def common_words(self, texts: list[str]) -> np.ndarray:
        """Occurrences of each word of the vocabulary, case and punctuation aside; one row a text."""
        w = kernel.words([t.lower() for t in texts], kernel.PUNCTUATION)
        known, order = _vocabulary_hashes()
        at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
        hit = known[at] == w.hash
        cells = w.text[hit] * len(VOCABULARY) + order[at[hit]]
        self.n_plain_words = np.diff(w.first)
        return np.bincount(cells, minlength=len(texts) * len(VOCABULARY)).reshape(len(texts), -1)
