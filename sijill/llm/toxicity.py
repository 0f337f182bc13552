"""Toxicity by noisy-channel deobfuscation.

A token that looks disguised (letters and look-alike signs or digits in any place, letters
stretched, letters set apart) is a lattice of what each character may stand for: itself, a
look-alike letter, or nothing. Viterbi decoding under a character trigram model of the corpus
picks the likeliest restored word. Words, as written and as restored, are scored by the weights
that a logistic regression gives them and their prefixes.

The language model counts the words of all documents, labelled or not, by their occurrences; words
with ideographs or syllable signs don't count, and such letters stand for themselves. Only the
classifier is fitted on a sample: at most TRAIN_ROWS labelled documents outside the held-out fold,
the first by a hash of doc_id. Its features are those of at least LEAST_TOXIC different toxic
texts of the sample with enough evidence for them, at most MOST_FEATURES, all under a penalty.
Rows that share a doc_id count once, with their greatest text. Documents labelled twice count as
toxic if any label is above 0; null labels are ignored. Null and empty texts get the regression's
value without features. Repeated rows each give a row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, kept, remainder, texts

TRAIN_ROWS, FOLDS = 20_000, 5
LEAST_TOXIC, LEAST_WEIGHT, LEAST_EVIDENCE, MOST_FEATURES, PENALTY = 4, 2.0, 10.0, 1000, 0.03
PREFIXES = (4, 5, 6)

# Letters that signs and digits look like.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "(": "c", "€": "e", "£": "l"}
SEPARATORS = " .-_*~'"
IDEOGRAPHS = "\u2e80"  # from here on letters are ideographs or syllable signs, too many for a table of trigrams

LOOK = "".join(map(re.escape, LOOKALIKES))
DISGUISED = re.compile(rf"[^\W\d_].*[{LOOK}*._~-]|[{LOOK}].*[^\W\d_]|(\w)\1\1", re.DOTALL)
SPACED = re.compile(r"(?<!\S)(?:\w[ .\-_*]){2,}\w(?!\S)")
EDGE = ".,;:?!\"'()[]{}<>#%&*~|/\\-_=`^"
OUTER = "".join(c for c in EDGE if c not in LOOKALIKES)  # signs at the edges that stand for no letter
RUNS = re.compile(r"[^\W\d_]+")
#: Longer tokens are no words; only their runs of letters count.
LONGEST = 100
SUBSTITUTION, SKIP, REPEAT, DROP = math.log(0.3), math.log(0.5), math.log(0.4), math.log(0.01)


@dataclass
class Model:
    trigrams: dict[str, int] = field(default_factory=dict)
    bigrams: dict[str, int] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    offset: float = -2.0
    letters: int = 60

    def letter(self, before: str, c: str) -> float:
        """log probability of a letter, or of the end ($), after two others."""
        return math.log((self.trigrams.get(before + c, 0) + 0.1) / (self.bigrams.get(before, 0) + 0.1 * (self.letters + 1)))

    def restore(self, token: str) -> str:
        """The likeliest word behind a disguised token."""
        states = {"^^": (0.0, "")}
        for i, c in enumerate(token):
            arcs = []
            if c.isalpha():
                arcs.append((c, 0.0))
                if i and token[i - 1] == c:
                    arcs.append(("", REPEAT))
            arcs += [(x, SUBSTITUTION) for x in LOOKALIKES.get(c, "")]
            if c in SEPARATORS:
                arcs.append(("", SKIP))
            if not c.isalpha():
                arcs.append(("", DROP))
            after: dict[str, tuple[float, str]] = {}
            for before, (score, word) in states.items():
                for x, cost in arcs:
                    s = score + cost + (self.letter(before, x) if x else 0.0)
                    key = (before + x)[-2:]
                    if key not in after or (s, word + x) > after[key]:
                        after[key] = (s, word + x)
            states = after
        return max((s + self.letter(b, "$"), w) for b, (s, w) in states.items())[1]

    def forms(self, token: str) -> list[str]:
        """What a token may say: its runs of letters, and the restored word."""
        core, outer = token.strip(EDGE), token.strip(OUTER)
        out = [core] if core.isalpha() else RUNS.findall(core)
        for t in {core, outer}:
            if len(t) <= LONGEST and (" " in t or DISGUISED.search(t)):
                out.append(self.restore(t))
        return out

    def weighed(self, token: str) -> tuple[str, ...]:
        """Features of what a token may say that have a weight."""
        return tuple({f for word in self.forms(token) for f in features(word) if f in self.weights})


def features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]


def tokens(text: str) -> set[str]:
    """Different tokens of a text in lower case; letters set apart are also one token."""
    low = text.lower()
    found = set(low.split())
    if SPACED.search(low):
        found.update(m[0] for m in SPACED.finditer(low))
    return found


def counted(docs: DataFrame, count) -> DataFrame:
    """Sums of what count(texts, toxic) gives as key -> number, added up in Spark."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = count(batch.column("text").to_pylist(), batch.column("toxic").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["key", "n"])

    return docs.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def letter_counts(some: list[str], toxic: list[int]) -> Counter:
    """Trigrams of the texts' words, by occurrences, so that sums don't depend on batches."""
    found: Counter = Counter()
    for word, n in Counter(w for t in some for w in RUNS.findall(t.lower())).items():
        if max(word) < IDEOGRAPHS:
            w = f"^^{word}$"
            for i in range(len(word) + 1):
                found[w[i : i + 3]] += n
    return found


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Letters and weights; what reaches the driver is bounded by the alphabet and the parameters."""
    spark, model = docs.sparkSession, Model()
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("int") > 0).cast("int").alias("toxic"))
              .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != 0))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(TRAIN_ROWS))
    # the broadcast side holds TRAIN_ROWS rows of two numbers at most
    train = checkpointed(spark, texts(docs).join(F.broadcast(chosen.drop("place")), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.any_value("toxic").alias("toxic")))
    sizes = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return model

    every = texts(docs, F.lit(0).alias("toxic"))  # the language model is of the whole corpus, not of the sample
    model.trigrams = {r.key: r.n for r in counted(every, letter_counts).collect()}
    for key, n in model.trigrams.items():
        model.bigrams[key[:2]] = model.bigrams.get(key[:2], 0) + n
    model.letters = len({c for key in model.trigrams for c in key} - {"^", "$"})

    def of_documents(wanted):
        def count(some, toxic):
            found: Counter = Counter()
            for t in some:
                here = {f for token in tokens(t) for word in model.forms(token) for f in features(word)}
                found.update(here if wanted is None else here & wanted)
            return found
        return count

    different = train.filter("toxic = 1").select("text", "toxic").distinct()  # copies of one text are no evidence
    seen = counted(different, of_documents(None)).filter(F.col("n") >= LEAST_TOXIC)
    seen = {r.key: r.n for r in seen.collect()}  # of TRAIN_ROWS texts at most
    clean = {r.key: r.n for r in counted(train.filter("toxic = 0"), of_documents(set(seen))).collect()}
    weights = {f: math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean.get(f, 0) + 0.5) / (n_clean + 1)) for f, n in seen.items()}
    best = sorted((f for f, w in weights.items() if w >= LEAST_WEIGHT and w * seen[f] >= LEAST_EVIDENCE), key=lambda f: (-weights[f] * math.sqrt(seen[f]), f))
    best = best[:MOST_FEATURES]
    model.weights = dict.fromkeys(best, 1.0)
    place = {f: i for i, f in enumerate(best)}

    def present(batches):
        import pyarrow as pa

        for batch in batches:
            found = [sorted({place[f] for token in tokens(t) for f in model.weighed(token)}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])

    rows = train.select("toxic", "text").mapInArrow(present, "toxic int, found array<int>").collect()  # a sample's few features
    x, y = np.zeros((len(rows), len(best) + 1), np.float32), np.array([r.toxic for r in rows], np.float32)
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, r.found] = 1
    w = regression(x, y)
    model.weights, model.offset = dict(zip(best, w[:-1].tolist(), strict=True)), float(w[-1])
    return model


def regression(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, penalised but for the last."""
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None].astype(np.float32))).astype(np.float64) + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w


class Sums:
    """The weights of a text's different features, added up; what is known of words is kept while it is little."""

    def __init__(self, model: Model):
        self.model, self.known, self.heavy = model, set(), {}

    def of(self, text: str) -> float:
        found = tokens(text)
        new = found - self.known
        if new:
            if len(self.known) > 100_000:
                self.known.clear()
                self.heavy.clear()
                new = found
            self.known |= new
            for token in new:
                own = self.model.weighed(token)
                if own:
                    self.heavy[token] = own
        return math.fsum(self.model.weights[f] for f in {f for token in found & self.heavy.keys() for f in self.heavy[token]})


def summed(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """doc_id, the columns to keep, and x: the sum of each text."""

    def run(batches):
        import pyarrow as pa

        kept("toxicity")
        sums = Sums(model)
        for batch in batches:
            x = [sums.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(k) for k in keep), pa.array(x, pa.float64())],
                                             names=["doc_id", *keep, "x"])

    docs = docs.select("doc_id", "text", *keep)
    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.mapInArrow(run, f"doc_id long, {kinds}, x double")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs, with all their columns, that score below one half."""
    model, at = fit(docs, labels), docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        kept("toxicity")
        sums = Sums(model)
        for batch in batches:
            keep = [sums.of(t or "") + model.offset < 0 for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    found = summed(texts(docs, (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out")), model, "held_out")
    p = 1 / (1 + F.exp(-(F.col("x") + model.offset)))
    return found.select("doc_id", "held_out", p.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
