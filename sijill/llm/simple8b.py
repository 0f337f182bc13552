"""Simple-8b: unsigned integers packed into 64-bit words, and a file of token ids made of them.

The top four bits of a word select how many values of how many bits the other sixty hold.
An escape word announces one value of over sixty bits, which stands raw in the next word.
Values are coded in blocks; the offset of each block's first word is kept, so any block is
decoded by itself, with array operations over all of its words.

File, little-endian: magic, counts, document ids, validity, lengths, block offsets, words.
"""

from __future__ import annotations

import struct

import numpy as np

# Values a word and bits a value, by selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 14
BLOCK = 1 << 15
MAGIC = b"S8BIDS01"
HEAD = struct.Struct("<8sQQQQ")


def widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; where the conversion to double rounds up, one too many."""
    return np.frexp(values.astype(np.float64))[1]


def encode_block(values: np.ndarray) -> np.ndarray:
    """Words of the values: the densest selector that fits at each place, from left to right."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    values = values.astype(np.uint64)
    width = widths(values)
    most = int(width.max())
    chosen = np.full(n, ESCAPE, np.int8)
    for s in range(len(COUNTS) - 1, -1, -1):
        if BITS[s] >= most:
            chosen[:] = s
            continue
        fits, run = np.ones(n + COUNTS[s], bool), 1  # past the end anything fits
        np.less_equal(width, BITS[s], out=fits[:n])
        while run < COUNTS[s]:  # fits[i] tells of the `run` values from i on
            step = min(run, COUNTS[s] - run)
            fits[:-step] &= fits[step:]
            run += step
        if not fits[:n].any():
            break  # fewer bits for more values fit nowhere either
        chosen[fits[:n]] = s
    step = np.array([*COUNTS, 1])[chosen].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts)
    chosen = chosen[starts]
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(chosen == ESCAPE)[:-1]])
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), np.uint64)
    padded = np.concatenate([values, np.zeros(COUNTS[0], np.uint64)])
    for s in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[rows]] = np.uint64(ESCAPE << 60)
            words[place[rows] + 1] = values[starts[rows]]
            continue
        k = np.arange(COUNTS[s])
        parts = padded[starts[rows][:, None] + k] << (k * BITS[s]).astype(np.uint64)
        words[place[rows]] = np.bitwise_or.reduce(parts, axis=1) | np.uint64(s << 60)
    return words


def decode_block(words: np.ndarray, count: int) -> np.ndarray:
    """The count values of a block."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[i]:
            raw[i + 1] = True
    held = np.array([*COUNTS, 0, 0])[selector]
    held[raw] = 1
    ends = np.cumsum(held)
    starts = ends - held
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in np.unique(selector[~raw]).tolist():
        if s == ESCAPE:
            continue
        rows = np.flatnonzero((selector == s) & ~raw)
        some, low = words[rows], np.uint64((1 << BITS[s]) - 1)
        k = np.arange(COUNTS[s])
        out[starts[rows][:, None] + k] = (some[:, None] >> (k * BITS[s]).astype(np.uint64)) & low
    out[starts[raw]] = words[raw]
    return out[:count]


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> list[bytes]:
    """Chunks of a file that holds the documents' ids, one document after the other."""
    blocks = [encode_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    return [
        HEAD.pack(MAGIC, len(doc_ids), len(ids), len(blocks), BLOCK),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array(lengths, "<u8").tobytes(),
        offsets.tobytes(),
        *(b.astype("<u8").tobytes() for b in blocks),
        np.array([d is not None for d in doc_ids], "u1").tobytes(),
    ]


class Reader:
    """A file's documents and their ids, decoded block by block."""

    def __init__(self, data):
        magic, docs, self.n_ids, blocks, self.block = HEAD.unpack_from(data, 0)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        at = HEAD.size
        stored = np.frombuffer(data, "<i8", docs, at)
        at += 8 * docs
        self.lengths = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
        at += 8 * docs
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        at += 8 * (blocks + 1)
        self.words = np.frombuffer(data, "<u8", int(self.offsets[-1]), at)
        valid = np.frombuffer(data, "u1", docs, at + 8 * len(self.words))
        self.doc_ids = [d if v else None for d, v in zip(stored.tolist(), valid.tolist(), strict=True)]

    def ids(self, start: int, length: int) -> np.ndarray:
        """Ids from start on, from the blocks that hold them only."""
        if not length:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (start + length - 1) // self.block
        out = np.concatenate([self.decoded(b) for b in range(first, last + 1)])
        return out[start - first * self.block :][:length]

    def decoded(self, b: int) -> np.ndarray:
        if getattr(self, "kept", (None, None))[0] != b:
            count = min(self.block, self.n_ids - b * self.block)
            self.kept = b, decode_block(self.words[self.offsets[b] : self.offsets[b + 1]], count).astype("<u4")
        return self.kept[1]
