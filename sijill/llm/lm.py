"""Interpolated modified Kneser-Ney bigram model, counted in Spark, looked up in mapped files.

Counting runs in three steps. Words: each task sums its own words, blobs of hashes and counts
are dealt by hash range, and each range is merged into one sorted array file. Pairs: likewise,
by the range of the first word; pairs after a very frequent first word, which would all fall
into one range, are dealt by their second word instead. Continuations: from the distinct pairs
of each range, dealt by the second word. Files go to the shared folder, whole or not at all,
under names of their own. Scoring tasks map them into memory and look up sorted keys.

A word is known by a 64-bit hash, exact but for chance collisions; a pair by the upper halves
of both words' hashes. Text is UTF-8; A-Z count as lower case; tokens are runs of anything but
white space (ASCII), and one end for each text. Null and empty texts hold the end only. If no
row is left to learn from, all tokens are equally likely. Repeated rows count, and are scored,
each for itself; the rows of an empty table are none. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import WordHashes, checkpointed, kept, parts, read_file, remainder, shared_folder, texts, write_file
from .wordbpe import chunked

FOLDS, HELD_OUT = 7, 2
CHUNK = 6_000_000  # characters treated together
END, START = np.uint64(xxh3_64_intdigest(b"")), np.uint64(xxh3_64_intdigest(b" start"))  # no token is empty or has a space
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
HALF = np.uint64(32)
#: A first word is frequent from this share of a mean range on.
FREQUENT = 1 / 8


@dataclass
class Model:
    """Where the files are and the few numbers that hold for all of them."""

    folder: str
    ranges: int
    tokens: int = 0
    words: int = 0
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    frequent_context: np.ndarray = field(default_factory=lambda: np.zeros((0, 4)))
    pair_discounts: tuple = (0.0, 0.0, 0.0)
    word_discounts: tuple = (0.0, 0.0, 0.0)
    pairs: int = 0
    word_rest: float = 1.0


# arrays as bytes

def pack_sorted(keys: np.ndarray) -> bytes:
    """Differences of ascending keys, by planes of bytes: the upper planes compress to nothing."""
    steps = np.diff(keys, prepend=np.zeros(1, keys.dtype))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), -1).T).tobytes()


def unpack_sorted(data: bytes, kind=np.uint64) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte a count; 255 stands for one of the large counts that follow, in order."""
    small, large = np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255].astype("<u8")
    return np.array([len(counts)], "<u8").tobytes() + small.tobytes() + large.tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    counts = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.uint8, -1, 8 + n).view("<u8")
    return counts


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = np.diff(starts, append=len(keys)) if counts is None else np.add.reduceat(counts, starts)
    return keys[starts], sums


def range_of(upper: np.ndarray, ranges: int) -> np.ndarray:
    """Range of the upper halves of hashes; ascending with them."""
    return (upper.astype(np.uint64) * np.uint64(ranges)) >> HALF


def dealt(keys: np.ndarray, counts: np.ndarray, ranges: int, base: int = 0) -> list[tuple[int, bytes, bytes]]:
    """Blobs of ascending keys and their counts, by range."""
    cuts = np.searchsorted(range_of(keys >> HALF, ranges), np.arange(ranges + 1, dtype=np.uint64))
    return [(base + r, pack_sorted(keys[a:b]), pack_counts(counts[a:b])) for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]


BLOBS = "bucket int, keys binary, counts binary"


def blob_batch(rows):
    import pyarrow as pa

    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["bucket", "keys", "counts"])


def joined(table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([unpack_sorted(x) for x in table.column("keys").to_pylist()])
    return summed(keys, np.concatenate([unpack_counts(x) for x in table.column("counts").to_pylist()]))


class Tokens:
    """Hashes of the tokens of some texts, one after the other, and of the token before each."""

    def __init__(self, some: list[str], hashes: WordHashes):
        words: list[bytes] = []
        lengths = []
        for t in some:
            own = t.encode("utf-8", "replace").translate(LOWER).split()
            words += own
            words.append(b"")
            lengths.append(len(own) + 1)
        self.lengths = np.array(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.words = hashes.array(words)
        self.before = np.concatenate([[START], self.words[:-1]])
        self.before[self.starts] = START

    def pairs(self, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and whether the first word is a frequent one, where the second comes first."""
        first, second = self.before >> HALF, self.words >> HALF
        often = np.isin(first, frequent)
        return np.where(often, (second << HALF) | first, (first << HALF) | second), often


def per_task(docs: DataFrame, count) -> DataFrame:
    """Blobs of what count(texts) finds in each chunk, added up within each task."""

    def run(batches):
        hashes, counted = kept("hashes", WordHashes), {}
        for batch in batches:
            some = batch.column("text").to_pylist()
            for a, b in chunked(some, CHUNK):
                for base, keys in count(Tokens(some[a:b], hashes)).items():
                    counted.setdefault(base, []).append(summed(keys))
                for base, found in counted.items():
                    if len(found) >= 8:
                        counted[base] = [summed(*map(np.concatenate, zip(*found, strict=True)))]
        rows = []
        for (base, ranges), found in counted.items():
            rows += dealt(*summed(*map(np.concatenate, zip(*found, strict=True))), ranges, base)
        for a in range(0, len(rows), 64):
            yield blob_batch(rows[a : a + 64])

    return docs.mapInArrow(run, BLOBS)


def of_counts(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, and 3 or more."""
    return [*(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts >= 3).sum())]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; fixed ones where the counts are too few to tell."""
    if min(n1, n2, n3, n4) == 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(x, 0.01), k - 0.01) for k, x in zip((1, 2, 3), d, strict=True))


def save(uri: str, **arrays: np.ndarray) -> None:
    """Arrays one after the other behind a head of their lengths; all start at eight bytes."""
    names = list(arrays)
    head = np.array([len(arrays[n]) for n in names], "<u8").tobytes()
    chunks = [head]
    for n in names:
        raw = np.ascontiguousarray(arrays[n]).tobytes()
        chunks += [raw, b"\0" * (-len(raw) % 8)]
    write_file(uri, chunks)


def load(uri: str, *kinds: str) -> list[np.ndarray]:
    """Views of the arrays that save() wrote."""
    data, out = read_file(uri), []
    lengths, at = np.frombuffer(data, "<u8", len(kinds)), 8 * len(kinds)
    for kind, n in zip(kinds, lengths.tolist(), strict=True):
        out.append(np.frombuffer(data, kind, n, at))
        at += -(-out[-1].nbytes // 8) * 8
    return out


# The arrays of each kind of file.
FILES = {"words": ("<u8", "<u8"), "pairs": ("<u8", "u1", "<u8", "<u8"), "contexts": ("<u4", "<u8", "<u8", "<u8", "<u8"), "after": ("<u4", "<u8")}


def fit(docs: DataFrame, ranges: int | None = None) -> Model:
    """Counts the texts of docs; the driver gets a few numbers a range, and the frequent words."""
    spark = docs.sparkSession
    model = Model(shared_folder(spark, "lm"), ranges or parts(docs))
    folder, ranges = model.folder, model.ranges

    def words(table):
        import pyarrow as pa

        bucket = table.column("bucket")[0].as_py()
        keys, counts = joined(table)
        save(f"{folder}/words-{bucket}", keys=keys, counts=counts.astype("<u8"))
        often = np.argsort(-counts)[:64]
        return pa.table({"tokens": [int(counts.sum())], "words": [len(keys)], "top": [keys[often].tobytes()], "top_n": [counts[often].tobytes()]})

    found = (per_task(docs, lambda t: {(0, ranges): t.words}).groupBy("bucket")
             .applyInArrow(words, "tokens long, words long, top binary, top_n binary").collect())
    model.tokens, model.words = sum(r.tokens for r in found), sum(r.words for r in found)
    if not found:
        return model
    top = np.concatenate([np.frombuffer(r.top, np.uint64) for r in found] + [np.array([START])])
    n = np.concatenate([np.frombuffer(r.top_n, np.int64) for r in found] + [np.array([model.tokens])])
    frequent = model.frequent = np.unique(top[n > FREQUENT * model.tokens / ranges] >> HALF)  # 8 * ranges at most

    def pair_keys(t):
        keys, often = t.pairs(frequent)
        return {(0, ranges): keys[~often], (ranges, ranges): keys[often]}

    def pairs(table):
        import pyarrow as pa

        bucket = table.column("bucket")[0].as_py()
        keys, counts = joined(table)
        large = counts >= 255
        save(f"{folder}/pairs-{bucket}", keys=keys, small=np.minimum(counts, 255).astype(np.uint8), at=np.flatnonzero(large).astype("<u8"), large=counts[large].astype("<u8"))
        low = keys & np.uint64(0xFFFFFFFF)
        first, second = (keys >> HALF, low) if bucket < ranges else (low, keys >> HALF)
        order = np.argsort(first, kind="stable") if bucket >= ranges else np.arange(len(first))
        firsts, sorted_counts = first[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], firsts[1:] != firsts[:-1]]))
        context = [np.add.reduceat(x.astype(np.int64), starts) for x in (sorted_counts, sorted_counts == 1, sorted_counts == 2, sorted_counts >= 3)]
        if bucket < ranges:
            save(f"{folder}/contexts-{bucket}", first=firsts[starts].astype("<u4"), **{f"c{i}": c.astype("<u8") for i, c in enumerate(context)})
            hot = np.zeros((0, 5), ">i8")
        else:
            hot = np.column_stack([firsts[starts].astype(np.int64), *context]).astype(">i8")
        after, n = summed(second << HALF)
        rows = dealt(after, n, ranges)
        stats = np.array([len(keys), *of_counts(counts)], np.int64).tobytes()
        rows.append((-1, stats, np.ascontiguousarray(hot).tobytes()))
        return pa.Table.from_batches([blob_batch(rows)])

    merged = checkpointed(spark, per_task(docs, pair_keys).groupBy("bucket").applyInArrow(pairs, BLOBS))
    rows = merged.filter("bucket < 0").select("keys").collect()
    stats = np.sum([np.frombuffer(r["keys"], np.int64) for r in rows], axis=0)
    model.pairs, model.pair_discounts = int(stats[0]), discounts(*stats[1:5].tolist())
    number = lambda k: F.conv(F.hex(F.substring("counts", F.col("i") * 40 + (8 * k + 1), F.lit(8))), 16, 10).cast("long")
    hot = (merged.filter("bucket < 0 and length(counts) > 0").select("counts", F.explode(F.expr("sequence(0, cast(length(counts) div 40 as int) - 1)")).alias("i"))
           .select(number(0).alias("word"), *(number(k).alias(f"c{k}") for k in range(1, 5)))
           .groupBy("word").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(1, 5))).collect())  # one row a frequent word
    model.frequent_context = np.zeros((len(frequent), 4))
    if hot:
        found = np.array(hot, np.int64)
        model.frequent_context[np.searchsorted(frequent, found[:, 0].astype(np.uint64))] = found[:, 1:]

    def after(table):
        import pyarrow as pa

        bucket = table.column("bucket")[0].as_py()
        keys, counts = joined(table)
        save(f"{folder}/after-{bucket}", second=(keys >> HALF).astype("<u4"), counts=counts.astype("<u8"))
        return pa.table({"stats": [np.array(of_counts(counts), np.int64).tobytes()]})

    rows = merged.filter("bucket >= 0").groupBy("bucket").applyInArrow(after, "stats binary").collect()
    n1, n2, n3, n4, more = np.sum([np.frombuffer(r["stats"], np.int64) for r in rows], axis=0).tolist()
    d = model.word_discounts = discounts(n1, n2, n3, n4)
    model.word_rest = (d[0] * n1 + d[1] * n2 + d[2] * more) / model.pairs
    return model


class Lookup:
    """A model's numbers for sorted keys, from files mapped range by range."""

    def __init__(self, model: Model):
        self.model = model

    def found(self, kind: str, keys: np.ndarray, upper: np.ndarray, base: int = 0):
        """(place of the first key, length, arrays, hits, positions of the hits) by range; keys ascend."""
        m = self.model
        cuts = np.searchsorted(range_of(upper, m.ranges), np.arange(m.ranges + 1, dtype=np.uint64))
        for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if a == b:
                continue
            try:
                arrays = load(f"{m.folder}/{kind}-{base + r}", *FILES[kind])
            except FileNotFoundError:  # no key fell into this range
                continue
            at = np.searchsorted(arrays[0], keys[a:b].astype(arrays[0].dtype))
            at[at == len(arrays[0])] = 0
            hit = np.flatnonzero(arrays[0][at] == keys[a:b])
            yield a + hit, arrays, at[hit]

    def words(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for rows, arrays, at in self.found("words", keys, keys >> HALF):
            out[rows] = arrays[1][at]
        return out

    def after(self, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(upper), np.int64)
        for rows, arrays, at in self.found("after", upper, upper):
            out[rows] = arrays[1][at]
        return out

    def contexts(self, upper: np.ndarray) -> np.ndarray:
        out = np.zeros((len(upper), 4))
        for rows, arrays, at in self.found("contexts", upper, upper):
            for k in range(4):
                out[rows, k] = arrays[k + 1][at]
        m = self.model
        if len(m.frequent):
            at = np.minimum(np.searchsorted(m.frequent, upper), len(m.frequent) - 1)
            hit = m.frequent[at] == upper
            out[hit] = m.frequent_context[at[hit]]
        return out

    def pairs(self, keys: np.ndarray, base: int) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for rows, (_, small, at_large, large), at in self.found("pairs", keys, keys >> HALF, base):
            counts = small[at].astype(np.int64)
            over = counts == 255
            counts[over] = large[np.searchsorted(at_large, at[over].astype(np.uint64))]
            out[rows] = counts
        return out

    def score(self, t: Tokens):
        """Training count of each token, and its log10 probability after the one before it."""
        m = self.model
        words, inverse = np.unique(t.words, return_inverse=True)
        counts = self.words(words)
        d = np.array([0.0, *m.word_discounts])
        n = self.after(words >> HALF)
        alone = np.maximum(n - d[np.minimum(n, 3)], 0) / max(1, m.pairs) + m.word_rest / (m.words + 1)
        alone = alone[inverse]
        firsts, back = np.unique(t.before >> HALF, return_inverse=True)
        context = self.contexts(firsts)
        d = np.array([0.0, *m.pair_discounts])
        rest = np.where(context[:, 0] > 0, context[:, 1:] @ d[1:] / np.maximum(context[:, 0], 1), 1.0)
        keys, often = t.pairs(m.frequent)
        n = np.zeros(len(keys), np.int64)
        for side, base in ((~often, 0), (often, m.ranges)):
            rows = np.flatnonzero(side)
            order = rows[np.argsort(keys[rows])]
            n[order] = self.pairs(keys[order], base)
        total = context[back, 0]
        p = np.maximum(n - d[np.minimum(n, 3)], 0) / np.maximum(total, 1) + rest[back] * alone
        return counts[inverse], np.log10(p)


OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document, with the base and the model's log10 probability of its text."""

    def run(batches):
        import pyarrow as pa

        hashes, lookup, names = kept("hashes", WordHashes), Lookup(model), [c.split()[0] for c in OUT.split(", ")]
        for batch in batches:
            doc_ids, some, held = (batch.column(k).to_pylist() for k in ("doc_id", "text", "held_out"))
            for a, b in chunked(some, CHUNK):
                t = Tokens(some[a:b], hashes)
                counts, logs = lookup.score(t)
                base = np.log10((counts + 1) / (model.tokens + model.words + 1))
                of = lambda x, t=t: np.add.reduceat(x, t.starts)
                total = of(logs)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:b], pa.int64()), pa.array(held[a:b], pa.bool_()), pa.array(t.lengths, pa.int64()), pa.array(of((counts > 0).astype(np.int64))),
                                                  pa.array([model.tokens] * (b - a), pa.int64()), pa.array(of(base)), pa.array(total), pa.array(10 ** (-total / t.lengths))], names=names)

    return docs.mapInArrow(run, OUT)


def fit_and_score(docs: DataFrame) -> DataFrame:
    """Learns from the documents that aren't held out, and scores all."""
    fold = remainder(F.col("doc_id"), FOLDS)
    model = fit(texts(docs).filter(fold != HELD_OUT).select("text"), parts(docs))
    return score(texts(docs, (fold == HELD_OUT).alias("held_out")), model)
