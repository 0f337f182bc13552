"""Byte-level BPE by segment trees, and its decoding.

Over the symbols of a piece stands a tree of adjacent pairs: a leaf holds the rank of the
merge of a symbol with the next one and its place, an inner node the lesser of its children.
So the root yields the leftmost merge of the lowest rank; a merge changes three leaves, each
with logarithmic work, and the piece is done when the root is empty.

Pieces of like length are encoded together, one tree a lane, with array operations over all
lanes; a few long pieces go through the same tree one by one. Each different piece of a batch
is encoded once. Null and empty texts have no ids; repeated rows each give a row.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
from pyspark.sql import DataFrame

from .common import kept, texts

# The pattern that cuts texts into pieces before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than space and line end; texts that hold it are cut by the pattern as a whole.
ODD_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: White space with the word after it: the pattern cuts such a unit as it would within the text.
UNIT = re.compile(r"[ \n]+[^ \n]*|[^ \n]+")
NONE = np.int64(1 << 62)
LANES = 1 << 18  # leaves treated together
FEW = 24  # lanes from which array operations pay


def byte_alphabet() -> dict[str, int]:
    """Byte of each letter of the vocabulary: printable bytes stand for themselves, the others, in order, for what follows U+00FF."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class BPE:
    #: Units kept between batches. It bounds memory only; ids don't depend on it.
    KEEP = 400_000

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        alphabet = byte_alphabet()
        self.bytes = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self.names = {i: str(i) for i in self.bytes}
        self.first = np.zeros(256, np.int64)
        for letter, b in alphabet.items():
            self.first[b] = vocab[letter]
        self.base = np.int64(max(self.bytes) + 1)
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.pairs = dict(zip(keys.tolist(), range(len(merges)), strict=True))
        self.pattern = regex.compile(PATTERN)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, tuple[str, bytes]] = {}

    # the trees

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE where there is none."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def lanes(self, symbols: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        """Ids of pieces of up to as many symbols as the matrix has columns, a power of two."""
        w, n = symbols.shape
        symbols = symbols.copy()
        after = np.tile(np.arange(1, n + 1), (w, 1))
        before = np.tile(np.arange(-1, n - 1), (w, 1))
        place = np.arange(n)
        ranks = np.full((w, n), NONE)
        ranks[:, :-1] = self.rank(symbols[:, :-1], symbols[:, 1:])
        ranks[place[None, :] >= lengths[:, None] - 1] = NONE
        tree = np.full((w, 2 * n), NONE)
        tree[:, n:] = np.where(ranks < NONE, ranks * n + place, NONE)
        for k in range(n - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])
        alive = np.ones((w, n), bool) & (place[None, :] < lengths[:, None])

        def put(rows, at, value):
            k = at + n
            tree[rows, k] = value
            k >>= 1
            while k[0]:
                tree[rows, k] = np.minimum(tree[rows, 2 * k], tree[rows, 2 * k + 1])
                k >>= 1

        def put_pair(rows, at):
            nxt = after[rows, at]
            inside = nxt < lengths[rows]
            r = self.rank(symbols[rows, at], symbols[rows, np.minimum(nxt, n - 1)])
            put(rows, at, np.where(inside & (r < NONE), r * n + at, NONE))

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            rank, at = np.divmod(tree[rows, 1], n)
            gone = after[rows, at]
            symbols[rows, at] = self.made[rank]
            alive[rows, gone] = False
            nxt = after[rows, gone]
            after[rows, at] = nxt
            some = nxt < lengths[rows]
            before[rows[some], nxt[some]] = at[some]
            put(rows, gone, np.full(len(rows), NONE))
            put_pair(rows, at)
            prev = before[rows, at]
            some = prev >= 0
            if some.any():
                put_pair(rows[some], prev[some])
            rows = rows[tree[rows, 1] < NONE]
        return [symbols[i, alive[i]].tolist() for i in range(w)]

    def single(self, symbols: list[int]) -> list[int]:
        """Ids of one piece by a tree of its own."""
        length, n = len(symbols), 1
        while n < length:
            n *= 2
        none, base, pairs, made = int(NONE), int(self.base), self.pairs, self.made
        after, before = list(range(1, length + 1)), list(range(-1, length - 1))
        tree = [none] * (2 * n)

        def leaf(i):
            j = after[i]
            r = pairs.get(symbols[i] * base + symbols[j]) if j < length else None
            return none if r is None else r * n + i

        def put(i, value):
            k = i + n
            tree[k] = value
            k >>= 1
            while k:
                value = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == value:
                    break
                tree[k] = value
                k >>= 1

        for i in range(length):
            tree[n + i] = leaf(i)
        for k in range(n - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        alive = [True] * length
        while tree[1] < none:
            rank, i = divmod(tree[1], n)
            j = after[i]
            symbols[i], alive[j] = int(made[rank]), False
            after[i] = after[j]
            if after[i] < length:
                before[after[i]] = i
            put(j, none)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        return [s for s, a in zip(symbols, alive, strict=True) if a]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            groups.setdefault(max(1, (len(p) - 1).bit_length()), []).append(i)
        for bits, rows in groups.items():
            n = 1 << bits
            if len(rows) < FEW:
                for i in rows:
                    out[i] = self.single(self.first[np.frombuffer(pieces[i], np.uint8)].tolist())
                continue
            step = max(1, LANES >> bits)
            for a in range(0, len(rows), step):
                some = rows[a : a + step]
                raw = np.frombuffer(b"".join(pieces[i].ljust(n, b"\0") for i in some), np.uint8).reshape(len(some), n)
                lengths = np.array([len(pieces[i]) for i in some])
                for i, ids in zip(some, self.lanes(self.first[raw], lengths), strict=True):
                    out[i] = ids
        return out

    # texts

    def segments(self, text: str) -> list[tuple[bool, str]]:
        """Runs between special tokens, and the special tokens."""
        if not self.specials or "<" not in text:
            return [(False, text)] if text else []
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [(False, text[at : m.start()])] if m.start() > at else []
            out.append((True, m[0]))
            at = m.end()
        return out + ([(False, text[at:])] if at < len(text) else [])

    def units(self, text: str) -> list[str]:
        """What is looked up as a whole; a special token is marked by a zero before it."""
        if "<" not in text and "\0" not in text:
            return self.pattern.findall(text) if ODD_SPACE.search(text) else UNIT.findall(text)
        out = []
        for special, part in self.segments(text):
            out += ["\0\0" + part] if special else self.pattern.findall(part)
        return out

    def learn(self, units: list[str]) -> None:
        """Ids, as decimals joined by commas, and decoded bytes of each new unit."""
        cut = [[] if u[:2] == "\0\0" and u[2:] in self.special else self.pattern.findall(u) for u in units]
        pieces = list({p for ps in cut for p in ps})
        name, raw, known = self.names.__getitem__, self.bytes.__getitem__, self.known
        done = {p: (",".join(map(name, ids)), b"".join(map(raw, ids)))
                for p, ids in zip(pieces, self.encode_pieces([p.encode() for p in pieces]), strict=True)}
        for u, ps in zip(units, cut, strict=True):
            if len(ps) == 1:
                known[u] = done[ps[0]]
            elif ps:
                both = [done[p] for p in ps]
                known[u] = ",".join([x[0] for x in both]), b"".join([x[1] for x in both])
            else:
                i = self.special[u[2:]]
                known[u] = name(i), raw(i)

    def encode_decode(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """For each text its ids joined by commas and the bytes that they decode to."""
        if len(self.known) > self.KEEP:
            self.known.clear()
        cut = [self.units(t) for t in texts]
        new: set[str] = set()
        for units in cut:
            new.update(units)
        new.difference_update(self.known)
        self.learn(list(new))
        of = self.known.__getitem__
        out = []
        for units in cut:
            found = list(map(of, units))
            out.append((",".join([x[0] for x in found]), b"".join([x[1] for x in found])))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_decode([text])[0][0].split(",") if i]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes[i] for i in ids).decode("utf-8", "replace")


def loaded(path: str) -> BPE:
    return kept(("bytes", path), lambda: BPE(path))


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row a document: the number of its ids, their digest, and the decoded text's digest."""

    def run(batches):
        import pyarrow as pa

        from .wordbpe import chunked

        bpe = loaded(tokenizer)
        for batch in batches:
            doc_ids, some = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunked(some):
                n, ids_hex, text_hex = [], [], []
                for ids, raw in bpe.encode_decode(some[a:b]):
                    n.append(ids.count(",") + 1 if ids else 0)
                    ids_hex.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_hex.append(hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:b], pa.int64()), pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
