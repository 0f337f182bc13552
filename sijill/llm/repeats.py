"""Substring dedup by hashing of passages of consecutive units.

A text is a row of tokens: words between ASCII signs and white space, in lower case; in scripts
without spaces each character is a token that counts as half a word. A unit begins at each line,
after sentence marks of many scripts, at words with a capital letter, and at tokens that a hash
picks, so that a passage which stands in the middle of a line has units of its own whatever its
case or script. Passages are the shortest rows of whole units of at least `least` words, one from
each unit on and one up to each unit, so a line or paragraph of so many words is covered by its
own passages; they are known by the hash of their tokens. A passage is a repeat if one document
with a smaller doc_id holds it, or if it stood earlier in its own text without overlap. Repeats
are removed with the white space after them; their offsets in the original text are kept. Shorter
repeats, such as common short sentences, stay; least=1 takes lines and units of any length.

Rows of one doc_id count as one document and don't remove each other's units. Null texts stay
null; empty texts stay empty; a null doc_id ranks first. An empty table gives no rows. An input
column named removed gives way to the operator's own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, kept, mix, shared_folder, texts
from .ordermin import NOBODY
from .wordbpe import chunked

MIN_WORDS = 10
#: One token of so many begins a unit.
EVERY = 8
CHUNK = 250_000  # characters treated together
# Code points of scripts without spaces, first and last; marks that end sentences, and other signs that aren't part of words.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x3FFFF)]
MARKS = ".!?…؟۔।॥。！？、，；"
SIGNS = "「」『』（）"
LETTER, SIGN, SPACE, LINE, MARK, ALONE = range(6)
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Characters:
    """What code points are, and powers for hashes of stretches."""

    def __init__(self):
        every = [chr(c) for c in range(1 << 16)]
        self.kind = np.array([LINE if c == "\n" else SPACE if c.isspace() else SIGN if c < "\x80" and not c.isalnum() else LETTER for c in every], np.uint8)
        for c in MARKS:
            self.kind[ord(c)] = MARK
        for c in SIGNS:
            self.kind[ord(c)] = SIGN
        for a, b in UNSPACED:
            own = self.kind[a : b + 1]
            own[own == LETTER] = ALONE
        self.capital = np.array([c.isupper() for c in every])
        self.value = mix(np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in every], np.uint64))
        self.power = self.inverse = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            self.power, self.inverse = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, x, np.uint64)]), dtype=np.uint64) for x in (ODD, ODD_INVERSE))
        return self.power[:n], self.inverse

    def stretches(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of stretches of values that don't depend on where they stand."""
        power, inverse = self.powers(len(values) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[: len(values)], dtype=np.uint64)])
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def picks(hashes: np.ndarray) -> np.ndarray:
    """Tokens that begin a unit by their hash."""
    return hashes % np.uint64(EVERY) == 0


class Passages:
    """The passages of some texts: text (its number), a and b (first and next character, counted over all texts) and digest, by text and place."""

    def __init__(self, some: list[str], known: Characters, least: int = MIN_WORDS):
        raw = "\n".join(some).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, np.uint32)
        lengths = np.array([len(t) for t in some])
        self.base = np.cumsum(lengths + 1) - lengths - 1
        self.known = known
        self.text = self.a = self.b = np.zeros(0, np.int64)
        self.digest = np.zeros(0, np.int64)
        low = np.minimum(codes, 0xFFFF)
        kind, value = known.kind[low], known.value[low]
        far = codes > 0xFFFF
        if far.any():
            alone = (codes >= UNSPACED[-1][0]) & (codes <= UNSPACED[-1][1])
            kind = np.where(far, np.where(alone, ALONE, LETTER), kind).astype(np.uint8)
            value = np.where(far, mix(codes.astype(np.uint64)), value)
        inside = np.concatenate([[False], (kind == LETTER) | (kind == ALONE), [False]])
        alone = np.concatenate([[False], kind == ALONE, [False]])
        edge = (inside[1:] & inside[:-1] & (alone[1:] | alone[:-1])) | (inside[1:] != inside[:-1])
        starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
        if not len(starts):
            return
        token = known.stretches(value, starts, ends)
        weight = np.where(kind[starts] == ALONE, 1, 2)
        text = np.searchsorted(self.base, starts, "right") - 1
        # what stands between a token and the one before it
        before = np.concatenate([[0], ends[:-1]])
        seen = lambda k: (c := np.concatenate([[0], np.cumsum(np.isin(kind, k))]))[starts] - c[before] > 0
        spaced, unspaced = seen((SPACE, LINE)), np.concatenate([[False], weight[:-1] == 1])
        first = np.concatenate([[True], text[1:] != text[:-1]])
        begin = first | seen((LINE,)) | (seen((MARK,)) & (spaced | unspaced)) | (known.capital[low[starts]] & spaced) | picks(token)
        unit = np.flatnonzero(begin)
        total = np.concatenate([[0], np.cumsum(weight)])
        after = np.append(unit[1:], len(starts))
        u, ue, owner = total[unit], total[after], text[unit]
        first_unit, last_unit = np.searchsorted(owner, owner, "left"), np.searchsorted(owner, owner, "right")
        every = np.arange(len(unit))
        j = np.searchsorted(ue, u + 2 * least, "left")
        i = np.searchsorted(u, ue - 2 * least, "right") - 1
        on, upto = j < last_unit, i >= first_unit
        pairs = np.unique(np.concatenate([every[on] * len(unit) + j[on], i[upto] * len(unit) + every[upto]]))
        i, j = pairs // len(unit), pairs % len(unit)
        # a unit reaches from the last white space before it to the next unit
        at = np.arange(len(codes))
        space = np.maximum.accumulate(np.where((kind == SPACE) | (kind == LINE), at, -1))
        space = np.where(starts > 0, space[starts - 1], -1)
        where = np.where(first, self.base[text], np.where(space >= before, space + 1, starts))[unit]
        until = np.where(last_unit == every + 1, (self.base + lengths)[owner], np.append(where[1:], 0))
        self.text, self.a, self.b = owner[i], where[i], until[j]
        self.digest = known.stretches(token, unit[i], after[j]).view(np.int64)

    def different(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, digest), each once."""
        order = np.lexsort((self.digest, self.text))
        text, digest = self.text[order], self.digest[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (digest[1:] != digest[:-1])
        return text[new], digest[new]

    def repeated(self, elsewhere: list) -> list[list[tuple[int, int]]]:
        """For each text the spans of repeated passages, joined where they touch, given the digests that smaller documents hold."""
        out: list[list[tuple[int, int]]] = [[] for _ in self.base]
        if not len(self.text):
            return out
        of = lambda text, digest: digest.astype(np.int64).view(np.uint64) ^ mix(text.astype(np.uint64) + np.uint64(1))
        own = of(self.text, self.digest)
        held = np.concatenate([np.zeros(0, np.int64), *(np.asarray(e, np.int64) for e in elsewhere)])
        hit = np.isin(own, of(np.repeat(np.arange(len(elsewhere)), [len(e) for e in elsewhere]), held))
        order = np.argsort(own, kind="stable")
        fresh = np.concatenate([[True], own[order][1:] != own[order][:-1]])
        ends = self.b[order][np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        hit[order] |= ends <= self.a[order]
        a, b, text = self.a[hit], self.b[hit], self.text[hit]
        if len(a):
            reach = np.maximum.accumulate(b)
            new = np.concatenate([[True], a[1:] > reach[:-1]])
            last = np.append(np.flatnonzero(new)[1:], len(a)) - 1
            for x, y, t in zip(a[new].tolist(), reach[last].tolist(), text[new].tolist(), strict=True):
                out[t].append((x - int(self.base[t]), y - int(self.base[t])))
        return out


def held(docs: DataFrame, least: int) -> DataFrame:
    """(digest, doc_id): each different passage of each document."""

    def run(batches):
        import pyarrow as pa

        known = kept("repeats", Characters)
        for batch in batches:
            ids, some = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b in chunked(some, CHUNK):
                text, digest = Passages(some[a:b], known, least).different()
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.int64()), pa.array(ids[a:b][text], pa.int64())], names=["digest", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "digest long, doc_id long")


def dedup(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs with shorter texts, and removed: the spans taken out, as start:end in the original, joined by commas; n_chars, if there is one, follows the text."""
    spark, columns = docs.sparkSession, [c for c in docs.columns if c != "removed"]
    rank, before = free_name(docs, "rank_of_doc"), free_name(docs, "held_before")
    keyed = docs.select(*columns, F.coalesce(F.col("doc_id").cast("long"), F.lit(NOBODY)).alias(rank))
    source = texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NOBODY)))
    path = f"{shared_folder(spark, 'repeats')}/held"
    held(source, least).write.parquet(path)  # both uses read it; a frequent digest is added up on the map side first
    every = spark.read.parquet(path)
    firsts = every.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    later = every.join(firsts, "digest").filter("doc_id > first").groupBy(F.col("doc_id").alias(rank)).agg(F.collect_list("digest").alias(before))
    joined = keyed.join(later, rank, "left").select(*columns, before)
    schema = joined.drop(before).schema.add("removed", "string")
    n_chars = "n_chars" in columns

    def run(batches):
        import pyarrow as pa

        known = kept("repeats", Characters)
        text_at = columns.index("text")
        for batch in batches:
            arrays = [batch.column(i) for i in range(len(columns))]
            some, said = arrays[text_at].to_pylist(), batch.column(len(columns)).to_pylist()
            out, removed, sizes = [], [], []
            for c, d in chunked([t or "" for t in some], CHUNK):
                passages = Passages([t or "" for t in some[c:d]], known, least)
                for t, spans in zip(some[c:d], passages.repeated([x or () for x in said[c:d]]), strict=True):
                    if spans:
                        pieces, at = [], 0
                        for a, b in spans:
                            pieces.append(t[at:a])
                            at = b
                        t = "".join(pieces) + t[at:]
                    out.append(t)
                    removed.append(",".join(f"{a}:{b}" for a, b in spans))
                    sizes.append(len(t) if spans else None)
            arrays[text_at] = pa.array(out, arrays[text_at].type)
            if n_chars:
                i = columns.index("n_chars")
                arrays[i] = pa.array([old if new is None else new for new, old in zip(sizes, arrays[i].to_pylist(), strict=True)], arrays[i].type)
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(removed, pa.string())], names=[*columns, "removed"])

    return joined.mapInArrow(run, schema)
