"""Ids of whole texts by a word-level BPE tokenizer file, through the tokenizers library.

The tokenizer drops white space between words, and none of its steps looks across it, so the
library encodes each different word of a batch once and the ids of a text are those of its
words in order. Words are cut at spaces and line ends only; other white space stays inside
a word, where the library treats it.
"""

from __future__ import annotations

import os
from collections import defaultdict
from itertools import count, islice

import numpy as np

from .common import kept


class WordEncoder:
    #: Letters up to this one are their own canonical form and have a simple lower case.
    SIMPLE = "\u00ff"

    def __init__(self, path: str, keep: int = 400_000):
        self.keep = keep  # words known between batches; it bounds memory only, ids don't depend on it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.lib, self.bare):
            t.no_truncation()
            t.no_padding()
        # words that are single runs of simple letters in lower case go through the merges alone
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.bare.model.end_of_word_suffix
        vocabulary = self.lib.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith(suffix)
        self.marks = {m: self.plain([m])[0] for m in ",."}
        self.forget()

    def forget(self) -> None:
        """Words get numbers as they are met; the ids of word i are pool[at[i]:at[i + 1]]."""
        self.index: dict = defaultdict(count().__next__)
        self.pool, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def cut(flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw, ends = flat.astype("<u4").tobytes(), (ends * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of any kind."""
        out = []
        for at in range(0, len(words), 20_000):
            ids = [e.ids for e in self.lib.encode_batch_fast(words[at : at + 20_000], add_special_tokens=False)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            out += self.cut(np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum())), np.cumsum(lengths))
        return out

    def simple(self, words: list[str]) -> list[bytes]:
        """Ids of runs of simple lower-case letters; each ends at a token that ends words."""
        out = []
        for at in range(0, len(words), 20_000):
            lines = [" ".join(words[i : i + 100]) for i in range(at, min(at + 20_000, len(words)), 100)]
            flat = np.concatenate([np.array(e.ids, np.uint32) for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)])
            out += self.cut(flat, np.flatnonzero(self.last[flat]) + 1)
        return out

    def learn(self, new: list) -> None:
        """Appends the ids of new words to the pool."""
        stems: dict[str, bytes] = {}
        of, rest = [], []
        for w in new:
            stem = w[:-1] if w[-1:] in (",", ".") else w
            if stem.isalpha() and (stem.isascii() or max(stem) <= self.SIMPLE):
                stem = stem.lower()
                stems[stem] = b""
                of.append(stem)
            else:
                of.append(None)
                rest.append(w)
        names = list(stems)
        stems.update(zip(names, self.simple(names), strict=True))
        others, marks = iter(self.plain(rest)), self.marks
        ids = [next(others) if stem is None else stems[stem] + marks[w[-1]] if w[-1] in marks else stems[stem] for w, stem in zip(new, of, strict=True)]
        ends = self.at[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        self.at = np.concatenate([self.at, ends])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), "<u4")])

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other and each with the end id, and how many each has."""
        if len(self.index) > self.keep:
            self.forget()
        words, numbers, known = [], [], len(self.index)
        for t in texts:
            own = t.replace("\n", " ").split(" ")
            words += own
            numbers.append(len(own))
        codes = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        self.learn(list(islice(self.index, known, None)))
        starts = self.at[codes]
        lengths = self.at[codes + 1] - starts
        ends = np.cumsum(lengths)
        last = np.cumsum(numbers)  # words up to each text's end
        before = np.concatenate([[0], ends])
        per_text = before[last] - before[last - numbers]
        ids = self.pool[np.arange(before[-1]) + np.repeat(starts - (ends - lengths), lengths)]
        return np.insert(ids, before[last], np.uint32(end)).astype("<u4"), per_text + 1


def encoder(path: str, keep: int = 400_000) -> WordEncoder:
    """One encoder for each Python worker."""
    return kept(("words", path, keep), lambda: WordEncoder(path, keep))


def chunked(texts: list[str], chars: int = 8_000_000):
    """Index ranges of about so many characters, one text at least."""
    a = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= chars:
            yield a, i + 1
            a, n = i + 1, 0
    if a < len(texts):
        yield a, len(texts)
