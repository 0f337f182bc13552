"""Near-duplicates by Order MinHash, verified by banded alignment.

Words are what is left between ASCII punctuation and white space, in lower case; a k-mer is five
words in a row (all of a shorter text). Occurrences of one k-mer in a text are told apart by
their number. A sketch takes, for each of several hash functions, the few k-mers that hash
lowest and joins them in the order in which they stand in the text, so two texts agree in a
sketch if they share k-mers and their order.

Texts of the same words form one node. Nodes that agree in a sketch meet in a bucket, which has a
leader. A node is compared with the leader of most of its buckets first, then with those others of
whose class it isn't yet, so that groups of copies become classes at a cost in proportion to the
members. Buckets whose nodes aren't all of one class then are gone through in
groups of bounded size, where nodes come with their words: numbers of words, and of words in each
of some bins, are bounds that hold for certain; what they admit is aligned at once unless links
already join it, and only links leave the group. So every two nodes of a bucket have been linked,
directly or through others, or compared.

Alignment: the edit distance of two texts in words, within the band of diagonals that the
similarity admits. Similarity is one minus the distance over the longer text's words; texts of
SIMILARITY or more are linked. Classes are the connected components of the links.

A document is what has one doc_id; rows that share it are linked. Null and empty texts form one
class, as texts of the same (no) words do. Rows without a doc_id take no part: they give one row
of nulls together. The class is the least doc_id in it. An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, kept, mix, texts
from .wordbpe import chunked

K, SKETCHES, TAKE = 5, 20, 3
SIMILARITY = 0.8
#: Bins of the words' counts, at first and then; a bucket of more than BLOCK nodes or WORDS words is gone through in pairs of blocks, smaller ones in groups of about WORDS words.
FEW_BINS, BINS, BLOCK, WORDS = 32, 512, 8192, 4_000_000
NOBODY = 1 - 2**63
SPACED = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


class Words(dict):
    """32-bit hash of each word met, kept while the table is small."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        h = self[word] = xxh3_64_intdigest(word) >> 32 | 1
        return h


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(SPACED).split()


def mers(flat: np.ndarray, lengths: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers of texts that stand one after the other, and how many each has."""
    count = np.where(lengths > 0, np.maximum(lengths - k + 1, 1), 0)
    starts = np.cumsum(lengths) - lengths
    first = np.arange(int(count.sum())) + np.repeat(starts - (np.cumsum(count) - count), count)
    last = np.repeat(starts + lengths, count)
    padded = np.concatenate([flat.astype(np.uint64), np.zeros(k, np.uint64)])
    h = np.zeros(len(first), np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.where(first + i < last, padded[first + i], 0)
        h ^= h >> np.uint64(29)
    return mix(h), count


def labelled(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that tell the occurrences of a k-mer in its text apart."""
    own = mix(h ^ (text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    order = np.argsort(own, kind="stable")
    same = np.concatenate([[False], own[order][1:] == own[order][:-1]])
    out = h.copy()
    if same.any():
        place = np.arange(len(h))
        number = place - np.maximum.accumulate(np.where(same, 0, place))
        out[order] += mix(number.astype(np.uint64)) * same
    return out


def sketches(h: np.ndarray, count: np.ndarray, n: int = SKETCHES, take: int = TAKE) -> np.ndarray:
    """For each text with k-mers n hashes of `take` lowest k-mers in the text's order."""
    rows = np.flatnonzero(count)
    count = count[rows]
    starts = np.cumsum(count) - count
    text = np.repeat(np.arange(len(rows)), count)
    marks = labelled(h, text)
    out = np.zeros((len(rows), n), np.uint64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for s in range(n):
        v = marks * np.uint64(2 * (s * 0x5851F42D4C957F2D % (1 << 62)) + 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF | 1)
        v ^= v >> np.uint64(31)
        v *= np.uint64(0xC4CEB9FE1A85EC53)
        v ^= v >> np.uint64(33)
        at = np.full((len(rows), take), -1, np.int64)
        for i in range(take):
            least = np.minimum.reduceat(v, starts)
            found = np.flatnonzero((v == np.repeat(least, count)) & (v != top))
            at[text[found], i] = found
            v[found] = top
        at.sort(axis=1)
        joint = np.full(len(rows), s, np.uint64)
        for i in range(take):
            joint = mix(joint * np.uint64(31) + np.where(at[:, i] >= 0, h[np.maximum(at[:, i], 0)], 0))
        out[:, s] = joint
    return out


def binned(flat: np.ndarray, lengths: np.ndarray, bins: int = BINS) -> np.ndarray:
    """How many words of each text fall into each bin: a row a bin, a column a text."""
    at = (mix(flat) % np.uint64(bins)).astype(np.int64) * len(lengths) + np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(at, minlength=len(lengths) * bins).astype(np.int32).reshape(bins, len(lengths))


def most_edits(n, least: float):
    """Edits that texts may be apart where the longer has n words."""
    return np.floor((1 - least) * n + 1e-9).astype(np.int64)


def possible(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, least: float) -> np.ndarray:
    """Whether texts of these bins and numbers of words can be as similar; false only if they surely aren't."""
    more = (np.abs(x - y).sum(axis=0) + np.abs(nx - ny)) // 2  # an edit takes one word from a bin, or gives one, or both
    return more <= most_edits(np.maximum(nx, ny), least)


def distance(a: list, b: list, most: int) -> int:
    """Edit distance of two lists, or most + 1 if it is greater.

    Bits stand for the rows of the band, `most` to each side of the diagonal; a column is worked
    out at once from the differences of the one before, then the band moves down by a row.
    """
    m, n = len(a), len(b)
    if abs(m - n) > most:
        return most + 1
    front = back = 0
    while front < min(m, n) and a[front] == b[front]:
        front += 1
    while back < min(m, n) - front and a[m - 1 - back] == b[n - 1 - back]:
        back += 1
    a, b = a[front : m - back], b[front : n - back]
    m, n = len(a), len(b)
    if not m or not n:
        return m + n
    where: dict = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    whole = (1 << 2 * most + 1) - 1
    up, down = whole ^ (1 << most) - 1, 0  # rows that are one more, one less than the row above
    now = min(m, most)  # distance at the row that is followed: the band's last, later the last of all
    for j, w in enumerate(b):
        same = where.get(w, 0)
        same = (same >> j - most if j > most else same << most - j) & whole
        flat = (((same & up) + up) ^ up | same | down) & whole  # no more than the cell before the row above
        right, left = down | whole & ~(flat | up), flat & up  # cells that are one more, one less than the column before
        if j + most < m:
            now += not flat >> 2 * most & 1
            if now > 2 * most + n - m:
                return most + 1
        else:
            bit = m - 1 - j + most
            now += (right >> bit & 1) - (left >> bit & 1)
            if now - (n - 1 - j) > most:
                return most + 1
        flat >>= 1
        up, down = left | whole & ~(flat | right), flat & right
    return now if now <= most else most + 1


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two texts by their words' hashes; 0 if it is below `least`."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    most = int(most_edits(longer, least))
    words, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    common = np.minimum(np.bincount(both[: len(a)], minlength=len(words)), np.bincount(both[len(a) :], minlength=len(words))).sum()
    if longer - common > most:
        return 0.0
    d = distance(a.tolist(), b.tolist(), most)
    return 0.0 if d > most else 1 - d / longer


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, node (a digest of the words), sketch, and the words' 32-bit hashes for each row."""

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest

        known = kept("mers", Words)
        for batch in batches:
            ids, some = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunked(some, 2_000_000):
                if len(known) > 150_000:  # bounds memory only
                    known.clear()
                flat, lengths, node = [], [], []
                for t in some[a:b]:
                    own = words(t)
                    flat += own
                    lengths.append(len(own))
                    node.append((xxh3_64_intdigest(b" ".join(own)) ^ 1 << 63) - (1 << 63))
                flat, lengths = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat)), np.array(lengths)
                h, count = mers(flat, lengths)
                found = sketches(h, count)
                sizes = np.where(count > 0, SKETCHES, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(found.ravel().view(np.int64)))
                ends = np.concatenate([[0], np.cumsum(lengths * 4)]).astype(np.int32)
                own = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(flat.astype(np.uint32))])
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(node, pa.int64()), lists, own], names=["doc_id", "node", "sketch", "words"])

    return texts(docs).mapInArrow(run, "doc_id long, node long, sketch array<long>, words binary")


def verified(pairs: DataFrame, of: DataFrame, least: float) -> DataFrame:
    """Pairs of nodes whose words (node, words) are similar enough."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            good = [aligned(np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32), least) > 0 for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(of.select(F.col("node").alias("b"), F.col("words").alias("y")), "b")
    both = both.join(of.select(F.col("node").alias("a"), F.col("words").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def within(table, least: float):
    """Links (a, b) that join what is similar enough among rows (key, node, class, own, apart, words) of one key, of different classes and, where `apart`, of different blocks."""
    import pyarrow as pa

    said = [np.frombuffer(x, np.uint32) for x in table.column("words").to_pylist()]
    n = np.array([len(x) for x in said])
    order = np.lexsort([n, table.column("key").to_numpy()])
    key, node, of, own, apart = (table.column(c).to_numpy()[order] for c in ("key", "node", "class", "own", "apart"))
    said, n = [said[i] for i in order], n[order]
    flat = np.concatenate(said).astype(np.uint64)
    few, bins = binned(flat, n, FEW_BINS), binned(flat, n)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    a, b = [], []
    for first, end in zip(starts.tolist(), np.append(starts[1:], len(key)).tolist(), strict=True):
        label = np.unique(of[first:end], return_inverse=True)[1]
        shortest = first + np.searchsorted(n[first:end], least * n[first:end] - 1e-6)
        for r in range(first + 1, end):
            # rows that come before, so no longer, and long enough
            other = label[shortest[r - first] - first : r - first] != label[r - first]
            if apart[r]:
                other &= own[shortest[r - first] : r] != own[r]
            at = shortest[r - first] + np.flatnonzero(other)
            for counts in (few, bins):
                at = at[possible(counts[:, at], counts[:, r : r + 1], n[at], n[r], least)]
            for c in at.tolist():
                if label[c - first] != label[r - first] and aligned(said[c], said[r], least):
                    a.append(min(node[c], node[r]))
                    b.append(max(node[c], node[r]))
                    label[label == label[c - first]] = label[r - first]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def others(members: DataFrame, of: DataFrame, least: float) -> DataFrame:
    """Links (a, b) in buckets (key, node, n, class) that hold nodes of different classes."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n_words"), F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("n_words") / WORDS)).cast("int").alias("blocks")
    sizes = checkpointed(members.sparkSession, sizes.select("key", "n_words", blocks))
    total = sizes.agg(F.sum("n_words")).first()[0] or 0
    # every two blocks of a bucket meet in one group: a block goes to as many groups as there are blocks; small buckets share groups
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    shared = F.pmod(F.xxhash64("key"), F.lit(max(1, total // WORDS))).cast("long")
    members = (members.join(sizes, "key").withColumn("own", own)
               .select("key", "node", "class", "own", F.when(F.col("blocks") > 1, F.col("key")).otherwise(shared).alias("part"), (F.col("blocks") > 1).alias("split"), F.explode(meets).alias("m"))
               .select("key", "node", "class", "own", (F.col("split") & (F.col("m.i") != F.col("m.j"))).alias("apart"), "part", "split", "m.i", "m.j"))
    return members.join(of, "node").groupBy("part", "split", "i", "j").applyInArrow(lambda t: within(t, least), "a long, b long")


def settled(df: DataFrame) -> DataFrame:
    """df in reliable storage, without Catalyst's estimate of its size: joins multiply estimates, so that in loops over tables that are made of each other their digits would double each time."""
    spark, df = df.sparkSession, checkpointed(df.sparkSession, df)
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(df._jdf.queryExecution().toRdd(), df._jdf.schema(), False), spark)


def components(links: DataFrame) -> DataFrame:
    """(node, class) for all nodes of the links, by contraction: each node points to its least neighbour, pointers are followed to their ends, and only links between different ends go on."""
    both = settled(links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l")).select("l.a", "l.b").distinct())
    labels = None
    while True:
        to = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("class")).select("node", F.least("node", "class").alias("class")))
        while True:
            up = to.select(F.col("node").alias("class"), F.col("class").alias("root"))
            step = settled(to.join(up, "class").select("node", F.col("class").alias("was"), F.col("root").alias("class")))
            to = step.select("node", "class")
            if step.filter("was != class").isEmpty():
                break
        labels = to if labels is None else replaced(labels, to)
        both = settled(between(both, to).distinct())
        if both.isEmpty():
            return labels


def between(links: DataFrame, label: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that label (node, class) has for the ends, without those within a class."""
    ends = links.join(label.select(F.col("node").alias("a"), F.col("class").alias("x")), "a").join(label.select(F.col("node").alias("b"), F.col("class").alias("y")), "b")
    return ends.filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b"))


def replaced(label: DataFrame, to: DataFrame) -> DataFrame:
    """label (node, class) with the classes that `to` (node, class) has for its classes."""
    up = to.select(F.col("node").alias("class"), F.col("class").alias("root"))
    return settled(label.join(up, "class", "left").select("node", F.coalesce("root", "class").alias("class")))


def linked(label: DataFrame, links: DataFrame) -> DataFrame:
    """label (node, class) after links (a, b) have joined classes."""
    return replaced(label, components(between(links, label)))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row a document: doc_id and class_id, the least doc_id of those it is alike to, directly or through others."""
    spark = docs.sparkSession
    unnamed = docs.filter(F.col("doc_id").cast("long").isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id")).limit(1)
    found = checkpointed(spark, sketched(docs.filter(F.col("doc_id").cast("long").isNotNull())))
    said = (F.octet_length("words") / 4).cast("int")
    nodes = checkpointed(spark, found.groupBy("node").agg(F.any_value("sketch").alias("sketch"), F.min("doc_id").alias("doc_id"), F.max(said).alias("n")))
    # rows of one doc_id with different words link those words' nodes
    texts_of = found.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    links = found.select("doc_id", "node").join(texts_of, "doc_id").filter("node > low").select(F.col("low").alias("a"), F.col("node").alias("b"))

    buckets = nodes.select("node", "n", F.explode("sketch").alias("key"))
    # one hash of nodes picks leaders, so that a group's buckets share theirs
    leader = F.min(F.struct(F.xxhash64("node").alias("rank"), F.col("node").alias("leader"))).alias("l")
    leaders = buckets.groupBy("key").agg(leader, F.count(F.lit(1)).alias("size")).filter("size > 1").select("key", "l.leader")
    members = checkpointed(spark, buckets.join(leaders, "key"))
    wanted = nodes.select("doc_id", "node").join(members.select("node").distinct(), "node", "left_semi")
    of = checkpointed(spark, found.select("doc_id", "node", "words").join(wanted, ["doc_id", "node"], "left_semi").select("node", "words").dropDuplicates(["node"]))
    # first each node meets one leader, that of most of its buckets; then those others of whose class it isn't yet
    met = members.filter("node != leader").groupBy(F.col("node").alias("a"), F.col("leader").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    met = checkpointed(spark, met)
    most = met.groupBy("a").agg(F.max(F.struct("times", F.xxhash64("b").alias("rank"), "b")).alias("m")).select("a", "m.b")
    label = replaced(nodes.select("node", F.col("node").alias("class")), components(checkpointed(spark, links.unionByName(verified(most, of, least)))))
    rest = met.select("a", "b").join(label.select(F.col("node").alias("a"), F.col("class").alias("x")), "a").join(label.select(F.col("node").alias("b"), F.col("class").alias("y")), "b")
    label = linked(label, checkpointed(spark, verified(rest.filter("x != y").select("a", "b"), of, least)))
    label = linked(label, checkpointed(spark, others(members.join(label, "node").select("key", "node", "n", "class"), of, least)))

    label = nodes.select("node", "doc_id").join(label, "node")
    label = label.join(label.groupBy("class").agg(F.min("doc_id").alias("class_id")), "class").select("node", "class_id")
    return found.select("doc_id", "node").join(label, "node").groupBy("doc_id").agg(F.min("class_id").alias("class_id")).unionByName(unnamed)


def first_of_class(docs: DataFrame, **parameters) -> DataFrame:
    """docs without all but the first document of each class; of rows that share a doc_id the one with the longest text stays, of equally long ones the greatest text.

    A row without a doc_id is a document of its own kind: it goes only if another such row has the same text.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("said"))
    named = docs.filter(F.col("doc_id").cast("long").isNotNull())
    first = classes(named, **parameters).filter("doc_id = class_id").select(F.col("doc_id").alias("id"))
    longest = F.max_by("row", F.struct(F.length("said"), "said")).alias("row")
    kept = whole.filter("id is not null").join(first, "id", "left_semi").groupBy("id").agg(longest).select("row.*")
    unnamed = whole.filter("id is null").groupBy("said").agg(F.any_value("row").alias("row")).select("row.*")
    return kept.unionByName(unnamed)
