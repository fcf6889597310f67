"""Token ids of the word-piece vocabulary, as packed little-endian unsigned 32-bit integers."""

from __future__ import annotations

import os
import struct
from string import punctuation
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from netfeat.llm.common import Memo, gaps, one_for_worker

#: Pieces that a worker keeps, twice over; some 200 bytes each.
MEMO = 1_100_000
_LONGEST = 64


class Tokenizer:
    """Encodes by the pieces between blanks, which its vocabulary never crosses: it drops white
    space before it looks for words. Each different piece of a call is looked up once; a new one is tokenised and kept.

    Of new pieces that are a word of letters, with punctuation after it or not, word and punctuation are tokenised apart, as
    the tokeniser parts them: a word in ASCII by the model alone, since it is its own normal form, others many at a
    time as one text; the ids that end a word part them again."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merge = self.model.model.tokenize
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.memo = Memo(memo)

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        encoded = self.model.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of letters only."""
        out = {}
        for lo in range(0, len(words), 1000):
            part = words[lo : lo + 1000]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            at = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
            if len(at) == len(part) + 1 and at[-1] == 4 * len(ids):
                raw = ids.tobytes()
                out.update((w, raw[a:b]) for w, a, b in zip(part, at, at[1:]))
            else:  # some word became several, as a few letters do in lower case
                out.update(zip(part, self._one_by_one(part)))
        return out

    def _ascii(self, word: str) -> bytes:
        """Ids of a word of lower-case ASCII letters."""
        ids = [t.id for t in self.merge(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces that are not in the memo's new generation."""
        known, old = self.memo.new.get, self.memo.old.get
        out: list[bytes | None] = list(map(old, pieces)) if self.memo.old else [None] * len(pieces)
        words: dict[str, bytes | None] = {}
        parted, other, tails = [], [], {}
        for k in gaps(out):
            p = pieces[k]
            word = p.rstrip(punctuation)
            # a letter's normal form may end with a mark, which belongs to the punctuation after it
            if not word.isalpha() or not (word.isascii() or normalize("NFC", word).lower().isalpha()):
                other.append(k)
                continue
            if word not in words:
                ids = None if len(word) == len(p) else known(word) or old(word)
                words[word] = self._ascii(word) if ids is None and word.isascii() and word.islower() else ids
            parted.append((k, word, p[len(word) :]))
        words.update(self._words([w for w, ids in words.items() if ids is None]))
        for k, word, tail in parted:
            if tail and tail not in tails:
                tails[tail] = self._one_by_one([tail])[0]
            out[k] = words[word] + tails[tail] if tail else words[word]
        for k, ids in zip(other, self._one_by_one([pieces[k] for k in other])):
            out[k] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        self.memo.turn()
        # the vocabulary is in lower case; outside ASCII the tokeniser's own rule decides
        plain = pa.array([(t.lower() if t.isascii() else t).replace("\n", " ") for t in texts], pa.large_string())
        split = pc.split_pattern(plain, " ")
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.memo.new.get, pieces))
        missing = gaps(found)
        if missing:
            learnt = self._learn([pieces[k] for k in missing])
            for k, ids in zip(missing, learnt):
                found[k] = ids
            self.memo.new.update((pieces[k], ids) for k, ids in zip(missing, learnt) if len(pieces[k]) <= _LONGEST)
        # the ids of the different pieces, end to end, and those of every piece picked from them
        ids = np.frombuffer(b"".join(found), "<u4")
        length = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        first = np.cumsum(length) - length
        of = coded.indices.to_numpy()
        each = length[of]
        end = np.cumsum(each)
        ids = ids[np.repeat(first[of] - end + each, each) + np.arange(end[-1] if len(end) else 0)].astype("<u4", copy=False)
        cut = np.concatenate(([0], end))[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cut, cut[1:])]


@one_for_worker
def tokenizer(path: str, memo: int = MEMO) -> Tokenizer:
    """One for each Python worker and vocabulary."""
    return Tokenizer(path, memo)
