"""The operators of sijill.llm against brute force, exact round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sijill.llm import bpe, hnsw, lm, ordermin, packing, repeats, secrets, simple8b, tokenids, topk, toxicity
from sijill.llm.queries import tokenizer

public = pytest.importorskip("public_tokenizers")
WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]


def both(odd_docs, no_docs, run, n=9):
    """An operator gives n rows over odd inputs and none over an empty table, with one schema."""
    out, none = run(odd_docs), run(no_docs)
    found = out.collect()
    assert out.schema == none.schema and none.count() == 0
    if n is not None:
        assert len(found) == n
    return found


# 1

def test_secrets_base(docs, rows):
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for doc_id, t in rows:
        found = [(m.start(), 0, m.end()) for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        r = got[doc_id]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(f[1] == k for f in found) for k in range(3))
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))


def test_secrets_novelty():
    s = secrets.Scanner()
    t = "the bearer value Zk9xQ2vL8mP4rT7wY1bN6cD3 and the token my_password_placeholder_here1 or Zk9xQ2vL8mP4rT7wY1bN6cD4"
    assert [(t[a:b], k) for a, k, b in s.spans(t)] == [("Zk9xQ2vL8mP4rT7wY1bN6cD3", 3), ("Zk9xQ2vL8mP4rT7wY1bN6cD4", 3)]
    assert s.spans("token " + "z" * 10_000 + "1") == [] and s.spans("") == []


def test_secrets_odd(odd_docs, no_docs):
    assert all(r.spans == "" for r in both(odd_docs, no_docs, secrets.scan))
    hidden = odd_docs.limit(1).withColumn("text", F.lit("x password=abcdef12 y")).withColumn("n_chars", F.lit(21))
    r = secrets.redact(hidden).first()
    assert r.text == "x [SECRET] y" and r.n_chars == 12 and r.key == "x"


# 2

def restated(rows):
    tok = lambda t: t.encode().translate(lm.LOWER).split() + [b"\0end"]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    uni, bi = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            w = tok(t)
            uni.update(w)
            bi.update(zip([b"\0start"] + w[:-1], w, strict=True))
    n, v = sum(uni.values()), len(uni)
    after = Counter(b for _, b in bi)
    dp, dw = ((0.0, *lm.discounts(*[sum(c == k for c in x.values()) for k in (1, 2, 3, 4)])) for x in (bi, after))
    context = defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), c in bi.items():
        context[a][0] += c
        context[a][min(c, 3)] += 1
    rest = sum(dw[min(c, 3)] for c in after.values()) / len(bi)

    def p(a, b):
        alone = max(after[b] - dw[min(after[b], 3)], 0) / len(bi) + rest / (v + 1)
        c = context.get(a)
        return alone if c is None else max(bi[a, b] - dp[min(bi[a, b], 3)], 0) / c[0] + sum(dp[k] * c[k] for k in (1, 2, 3)) / c[0] * alone

    for i, t in rows:
        w = tok(t)
        yield (i, held(i), len(w), sum(uni[x] > 0 for x in w), n, sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w),
               sum(math.log10(p(a, b)) for a, b in zip([b"\0start"] + w[:-1], w, strict=True)))


def test_lm(docs, rows):
    got = {r.doc_id: r for r in lm.fit_and_score(docs).collect()}
    better = []
    for i, held, n, known, total, base, score in restated(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-4)
        if held:
            better.append(r.score - r.base_score)
    assert sum(better) > 0


def test_lm_arrays():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(keys)) == keys).all()
    counts = np.array([1, 254, 255, 10**9, 3])
    assert lm.unpack_counts(lm.pack_counts(counts)).tolist() == counts.tolist()


def test_lm_counts_are_whole(tmp_path):
    """Counts beyond 32 bits come back as they were stored."""
    model, keys = lm.Model(f"file://{tmp_path}", 1), np.array([5, 9 << 32, 2**63], np.uint64)
    counts = np.array([1, 2**32 + 7, 2**50])
    lm.save(f"{model.folder}/words-0", keys=keys, counts=counts.astype(lm.FILES["words"][1]))
    large = counts >= 255
    lm.save(f"{model.folder}/pairs-0", keys=keys, small=np.minimum(counts, 255).astype(np.uint8), at=np.flatnonzero(large).astype("<u8"), large=counts[large].astype(lm.FILES["pairs"][3]))
    lookup = lm.Lookup(model)
    assert lookup.words(keys).tolist() == counts.tolist() == lookup.pairs(keys, 0).tolist()


def test_lm_frequent_words_are_split(spark):
    """A word that is a third of all tokens: its pairs go by their second word, with the same result."""
    r = random.Random(2)
    rows = [(i, " ".join(x for _ in range(200) for x in ("the", f"w{r.randint(0, 400)}", f"v{r.randint(0, 400)}"))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fold = lm.remainder(F.col("doc_id"), 7)
    model = lm.fit(df.filter(fold != 2), ranges=8)
    assert len(model.frequent)
    got = {r.doc_id: r.score for r in lm.score(df.withColumn("held_out", F.lit(False)), model).collect()}
    for i, *_, score in restated(rows):
        assert got[i] == pytest.approx(score, rel=1e-4)


def test_lm_odd(odd_docs, no_docs):
    rows = both(odd_docs, no_docs, lm.fit_and_score)
    assert all(r.n_tokens >= 1 and math.isfinite(r.score) for r in rows) and sum(r.n_tokens == 1 for r in rows) == 3


# 3

def test_simple8b():
    r = np.random.default_rng(0)
    for x in ([], [0], [0, 2**64 - 1, 5, 2**60, 2**60 - 1, 1], r.integers(0, 49408, 100_001), np.zeros(1000), 2 ** r.integers(0, 63, 5000), 2 ** r.integers(0, 3, 70_000)):
        x = np.array(x, np.uint64)
        assert (simple8b.decode_block(simple8b.encode_block(x), len(x)) == x).all()
    x = r.integers(0, 2**32, 100_000).astype("<u4")
    f = simple8b.Reader(b"".join(simple8b.encode_file([3, None, 9], [10, 0, 99_990], x)))
    assert f.doc_ids == [3, None, 9] and (f.ids(10, 99_990) == x[10:]).all() and len(f.ids(10, 0)) == 0
    assert len(simple8b.encode_block(np.zeros(60, np.uint64))) == 1


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path(name))


def test_token_ids(docs, rows):
    lib, start = library(WORD), 0
    got = {r.doc_id: r for r in tokenids.encode_and_read(docs, tokenizer(WORD)).collect()}
    for i, t in rows:
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_ids_odd(odd_docs, no_docs):
    found = sorted((r.start, r.n_tokens) for r in both(odd_docs, no_docs, lambda d: tokenids.encode_and_read(d, tokenizer(WORD))))
    assert all(a + n == b for (a, n), (b, _) in zip(found, found[1:]))


# 4

def test_bpe(docs, rows):
    lib = library(BYTE)
    got = {r.doc_id: r for r in bpe.encode_decode(docs, tokenizer(BYTE)).collect()}
    for i, t in rows:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_strange():
    own, lib, draw = bpe.BPE(public.path(BYTE)), library(BYTE), random.Random(3)
    cases = ["", "  a\tb <|endoftext|> x<|endoftext|>\n\n", "\0\0<|endoftext|> \0\0a", "a" * 3000, " \n x\n y \n\n\n z", "日本語 テスト🙂 1234 <", "foo\t  bar x  y", "don't I'LL,. x.."]
    cases += ["".join(draw.choice("ab \n\t\xa0é1'.<\x1c　") for _ in range(60)) for _ in range(300)]
    for t in cases:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids, skip_special_tokens=False), t


def test_bpe_trees_agree():
    own, draw = bpe.BPE(public.path(BYTE)), random.Random(4)
    pieces = ["".join(draw.choice("theiongdr") for _ in range(draw.randint(1, 40))).encode() for _ in range(500)]
    many = own.encode_pieces(pieces)
    assert many == [own.single(own.first[np.frombuffer(p, np.uint8)].tolist()) for p in pieces]


def test_bpe_odd(odd_docs, no_docs):
    assert sum(r.n_tokens == 0 for r in both(odd_docs, no_docs, lambda d: bpe.encode_decode(d, tokenizer(BYTE)))) == 2


# 5 and 7

def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [1.0, 2.0]), (100, [2.0, 1.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [0.0, 0.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (11, [1.0, 2.0]), (12, [-3.0, 1.0])]
    return spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "vec_id long, embedding array<float>, shard string, block int")


def test_nearest(spark):
    r = np.random.default_rng(5)
    x = np.concatenate([r.normal(size=(700, 16)), np.repeat(r.normal(size=(1, 16)), 300, 0)]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for q in hnsw.search(df, shard_rows=200).orderBy("query_id", "rank").collect():
        got[q.query_id].append((q.vec_id, q.score))
    hits, x = [], x.astype(np.float64)
    assert sorted(got) == list(range(0, 1000, 100))
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [int(i) for i in np.lexsort([np.arange(len(d)), d]) if i != q][:10]
        assert all(s == pytest.approx(d[i], rel=1e-12, abs=1e-12) for i, s in found) and len(found) == 10
        assert found == sorted(found, key=lambda f: (f[1], f[0]))
        hits.append(len({i for i, _ in found} & set(want)) / 10)
    assert np.mean(hits) >= 0.9


@pytest.mark.parametrize("size", [1e20, 1e-25, 1e150])
def test_graph_of_any_magnitude(size):
    """Very large and small vectors, also beside each other, and queries far outside the graph."""
    x = np.random.default_rng(8).normal(size=(800, 8))
    x[400:] *= size
    graph = hnsw.Graph.stored(hnsw.Graph(x).flat())
    outside = np.random.default_rng(9).normal(size=(20, 8)) * size * 1e8
    for points in (x[[3, 50, 399, 400, 650]], outside):
        unit = np.abs(points).max(axis=1)
        hits = []
        for q, u, found in zip(points, unit, graph.nearest(points, 10), strict=True):
            d = ((x / u) ** 2).sum(1) - 2 * (x / u) @ (q / u)  # the squared distance but for what all share
            assert len(set(found.tolist())) == 10 and found.min() >= 0
            hits.append(len(set(found.tolist()) & set(np.argsort(d)[:10].tolist())) / 10)
        assert np.mean(hits) >= 0.9


def test_graph_at_production_size():
    """One graph of more vectors than a beam meets: recall against brute force, and how few distances it measures."""
    x = np.random.default_rng(10).normal(size=(6000, 64))
    graph, measured = hnsw.Graph(x), []
    distances = graph.distances
    graph.distances = lambda points, nodes: measured.append(np.count_nonzero(nodes >= 0)) or distances(points, nodes)
    found = graph.nearest(x[::60], 11)
    want = np.argsort(((x[::60, None] - x[None]) ** 2).sum(2), 1)[:, :11]
    assert np.mean([len(set(a) & set(b)) / 11 for a, b in zip(found.tolist(), want.tolist(), strict=True)]) >= 0.9
    assert sum(measured) < 100 * len(x) / 2


def test_nearest_odd(spark):
    df = odd_vectors(spark)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in hnsw.search(df).collect()}
    assert [got[0, k][0] for k in (1, 2, 3, 4)] == [11, 50, 100, 12] and got[0, 1][1] == 0.0 and (0, 5) not in got
    assert got[100, 1][0] == 0 and hnsw.search(df.filter("false")).count() == 0


def test_top_k(spark):
    r = np.random.default_rng(6)
    x = np.concatenate([r.normal(size=(500, 12)), np.repeat(r.normal(size=(1, 12)), 200, 0), np.zeros((20, 12))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    whole = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    got = defaultdict(list)
    for q in topk.search(df, shard_rows=150).orderBy("query_id", "rank").collect():
        got[q.query_id].append((q.vec_id, q.score))
    assert sorted(got) == list(range(0, 720, 50))
    for q, found in got.items():
        s = whole @ whole[q]
        assert found == [(int(i), int(s[i])) for i in np.lexsort([np.arange(len(s)), -s]) if i != q][:5]


def test_top_k_stops_early():
    rows = np.zeros((5000, 3), np.int64)
    rows[:, 0] = np.arange(5000)
    lists = topk.Lists(np.arange(5000), rows)
    calls = []
    lists.scores, scores = lambda at, q: calls.append(len(at)) or scores(at, q), lists.scores
    assert lists.top(-1, np.array([1, 0, 0]), 2) == [(4999, 4999), (4998, 4998)] and sum(calls) < 200


def test_top_k_odd(spark):
    df = odd_vectors(spark)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.search(df).collect()}
    assert [got[0, k][0] for k in (1, 2, 3, 4, 5)] == [11, 50, 100, 7, 12] and got[0, 1][1] == 256 * 256 * 5
    assert topk.search(df.filter("false")).count() == 0


# 6

def check_packing(rows, length=4096):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length
    return pieces, sequences


def test_packing(docs, rows):
    lib, got = library(WORD), packing.pack(docs, tokenizer(WORD)).collect()
    pieces, sequences = check_packing(got)
    crcs = {(r.doc_id, r.start): r.ids_crc32 for r in got}
    for i, t in rows:
        ids, at = np.array([*lib.encode(t, add_special_tokens=False).ids, 2], "<u4"), 0
        for start, n, total in sorted(pieces[i]):
            assert start == at and total == len(ids) and crcs[i, start] == zlib.crc32(ids[start : start + n].tobytes())
            at += n
        assert at == len(ids)
    assert sum(sum(n for _, n in s) < 4096 for s in sequences.values()) <= 1  # one part of the table makes one rest


def test_packer_emits_the_fullest():
    p = packing.Packer(length=10, most=2)
    for i, n in enumerate([6, 7, 9, 4]):
        p.add(i, b"\1\0\0\0" * n)
    assert [[(d, len(x) // 4) for d, _, x, _ in s] for s in p.done] == [[(1, 7), (2, 3)], [(0, 6), (3, 4)]]
    assert [w[0] for w in p.windows] == [4]


def test_packing_odd(odd_docs, no_docs):
    got = both(odd_docs, no_docs, lambda d: packing.pack(d, tokenizer(WORD)), None)
    pieces, _ = check_packing(got)
    assert sum(n for _, n, _ in pieces[4]) == pieces[4][0][2] and pieces[1] == [(0, 1, 1)] and len(pieces[None]) == 1


# 8

def test_repeats(spark):
    shared = "Reen en the house of many. Etion was there for long. Enmentre came the other one as well. Ment of the whole world here."
    line = "This very line of more than ten words stands in several of the documents\n"
    rows = [(3, f"Some text that begins here and {shared} goes on as it likes to"), (1, f"Other words before {shared} and after it"), (2, "All of its own, nothing else."), (5, line + "own five"), (4, line + "own four"), (6, "Short one. own six"), (7, "Short one. own seven"), (8, None), (9, "")]
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in repeats.dedup(df).collect()}
    texts = dict(rows)
    for i in (1, 2, 4, 6, 7, 8, 9):
        assert got[i].text == texts[i] and got[i].removed == ""
    a, b = map(int, got[3].removed.split(":"))
    assert texts[3][a:b].strip() == shared and got[3].text == texts[3][:a] + texts[3][b:] and got[3].n_chars == len(got[3].text)
    assert got[5].text == "own five"


KNOWN = repeats.Characters()


def digests(*some):
    return [d for t in some for d in repeats.Passages([t], KNOWN).digest.tolist()]


def repeated(text, held):
    return repeats.Passages([text], KNOWN).repeated([held])[0]


def test_repeats_of_any_case_and_script():
    r = random.Random(3)
    some = lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    han = lambda n: "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(n))
    low = " ".join(some(60))
    for passage in (low, low.upper(), low.title(), han(80), " ".join(some(11))):
        line = passage + "\n"
        assert repeated("another\n" + line + "other end", digests("first one\n" + line + "its end")) == [(8, 8 + len(line))]
    german = " ".join(w.title() if i % 4 == 0 else w for i, w in enumerate(some(54)))
    for passage, sep, more in ((low, " ", lambda: " ".join(some(20))), (han(200), "", lambda: han(30)), (german, " ", lambda: " ".join(some(20)))):
        held = digests(more() + sep + passage + sep + more())
        text = more() + sep + passage + sep + more()
        at = text.index(passage)
        spans = repeated(text, held)
        assert spans and sum(b - a for a, b in spans) > len(passage) / 3
        assert all(at <= a and b <= at + len(passage) + 1 for a, b in spans)


def test_repeats_need_one_holder():
    """Short units that stand in different documents aren't a repeated passage."""
    parts = ["The River And ", "John Went To ", "In Paris He Saw ", "One Unit Of quite five words. ", "Mary Met Him."]
    assert repeated("".join(parts), digests(*(p + "\nand something else that no other document holds in it" for p in parts))) == []
    assert repeated("".join(parts), digests("".join(parts))) == [(0, len("".join(parts)))]


def test_short_lines_by_parameter(spark):
    df = spark.createDataFrame([(1, "one line of six words here\nfirst", "a"), (2, "second\none line of six words here\nend", "b")], "doc_id long, text string, rank_of_doc string").withColumn("held_before", F.lit(1))
    assert {r.text for r in repeats.dedup(df).collect()} == {r.text for r in df.collect()}
    got = {r.doc_id: r for r in repeats.dedup(df, least=6).collect()}
    assert got[2].text == "second\nend" and got[2].removed == "7:34" and got[2].rank_of_doc == "b" and got[2].held_before == 1


def restated_passages(t, least=10):
    """(a, b, words) of each passage, in plain loops; the choice of units by hash is the operator's own."""
    tokens = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+|[^\x00-\x7f\s.!?…]+", t)]
    tokens, joined_up = [], tokens
    for a, b in joined_up:  # letters of any script that touch are one word
        if tokens and tokens[-1][1] == a:
            tokens[-1] = tokens[-1][0], b
        else:
            tokens.append((a, b))
    begins, before = [], 0
    for n, (a, b) in enumerate(tokens):
        gap, space = t[before:a], max(t.rfind(c, before, a) for c in " \t\n")
        own = KNOWN.stretches(KNOWN.value[np.array([ord(c) for c in t[a:b]])], np.array([0]), np.array([b - a]))
        if not n or "\n" in gap or any(c in gap for c in ".!?…") and space >= 0 or t[a].isupper() and space >= 0 or repeats.picks(own)[0]:
            begins.append((0 if not n else space + 1 if space >= before else a, n))
        before = b
    ends = [at for at, _ in begins[1:]] + [len(t)]
    firsts = [n for _, n in begins] + [len(tokens)]
    found = set()
    for i in range(len(begins)):
        reach = [j for j in range(i, len(begins)) if firsts[j + 1] - firsts[i] >= least]
        found |= {(i, reach[0])} if reach else set()
        back = [k for k in range(i + 1) if firsts[i + 1] - firsts[k] >= least]
        found |= {(back[-1], i)} if back else set()
    return [(begins[i][0], ends[j], tuple(t[a:b].lower() for a, b in tokens[firsts[i] : firsts[j + 1]])) for i, j in sorted(found)]


def test_repeats_against_brute_force(docs, rows):
    got = {r.doc_id: r.removed for r in repeats.dedup(docs).collect()}
    seen, compared = set(), 0
    for i, t in rows:
        own, first, spans = restated_passages(t), {}, []
        for a, b, words in own:
            if words in seen or first.get(words, len(t) + 1) <= a:
                if spans and a <= spans[-1][1]:
                    spans[-1] = spans[-1][0], max(b, spans[-1][1])
                else:
                    spans.append((a, b))
            first.setdefault(words, b)
        assert got[i] == ",".join(f"{a}:{b}" for a, b in spans), i
        compared += bool(spans)
        seen |= {w for *_, w in own}
    assert compared > 10


def test_repeats_odd(odd_docs, no_docs):
    found = both(odd_docs, no_docs, repeats.dedup)
    assert sum(r.text is None for r in found) == 1 and {r.source for r in found} == {"z"}


# 9

def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    both = toxicity.score(docs, labels).filter("held_out").join(labels.filter("toxic is not null"), "doc_id").select("predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in both) / len(both)
    toxic = [r.predicted for r in both if r.toxic == 1]
    assert len(both) > 500 and right > 0.97 and sum(toxic) / len(toxic) > 0.85


def test_restored():
    m = toxicity.Model()
    m.trigrams = dict(toxicity.letter_counts(["idiot stupid loser clown moron trash pathetic the and with there worthless"] * 3, [0] * 3))
    for key, n in m.trigrams.items():
        m.bigrams[key[:2]] = m.bigrams.get(key[:2], 0) + n
    assert [m.restore(t) for t in ("1d10t", "stup!d", "l0$er", "i d i o t", "m.o.r.o.n", "looooser", "trrrash")] == ["idiot", "stupid", "loser", "idiot", "moron", "loser", "trash"]
    m.weights = {"=idiot": 5.0}
    sums = toxicity.Sums(m)
    assert sums.of("an 1d10t here") == 5.0 and sums.of("so i d i o t it is") == 5.0 and sums.of("nothing, IDIOT!") == 5.0 and sums.of("") == 0.0


def test_restored_against_all_restorations():
    """Viterbi's word scores as well as the best of all ways to read a token."""
    m = toxicity.Model()
    m.trigrams = dict(toxicity.letter_counts(["sails also aisle slot toil lots idle ideal said"] * 2, [0] * 2))
    for key, n in m.trigrams.items():
        m.bigrams[key[:2]] = m.bigrams.get(key[:2], 0) + n

    def readings(token):
        best = {}

        def go(i, before, word, score):
            if i == len(token):
                best[word] = max(best.get(word, -math.inf), score + m.letter(before, "$"))
                return
            c = token[i]
            arcs = [(c, 0.0)] if c.isalpha() else [("", toxicity.DROP)]
            arcs += [("", toxicity.REPEAT)] if c.isalpha() and i and token[i - 1] == c else []
            arcs += [(x, toxicity.SUBSTITUTION) for x in toxicity.LOOKALIKES.get(c, "")]
            arcs += [("", toxicity.SKIP)] if c in toxicity.SEPARATORS else []
            for x, cost in arcs:
                go(i + 1, (before + x)[-2:], word + x, score + cost + (m.letter(before, x) if x else 0.0))

        go(0, "^^", "", 0.0)
        return best

    r = random.Random(4)
    for _ in range(300):
        token = "".join(r.choice("sail1$0o.3 d|!t") for _ in range(r.randint(1, 8)))
        found = readings(token)
        assert found[m.restore(token)] == pytest.approx(max(found.values()))


def test_disguises_are_decoded():
    m = toxicity.Model()
    m.trigrams = dict(toxicity.letter_counts(["ass puss moron kill shit clown idiot дурак and the with"] * 5, [0] * 5))
    for key, n in m.trigrams.items():
        m.bigrams[key[:2]] = m.bigrams.get(key[:2], 0) + n
    for token, word in {"a55": "ass", "a$$": "ass", "pus5": "puss", "kil1": "kill", "sh1+": "shit", "(lown": "clown", "|diot": "idiot", "(a$$)": "ass", "дуррррак": "дурак", "a s s": "ass"}.items():
        assert word in m.forms(token), token
    assert m.forms("2024") == [] and m.forms("hello") == ["hello"] and "a s s" in toxicity.tokens("you a s s there")


def test_letters_of_the_whole_corpus(spark):
    """Unlabelled documents count, and how rows fall into batches and partitions doesn't."""
    docs = spark.createDataFrame([(1, "bad words"), (2, "good words"), *((i, "unlabelled zyzzyva") for i in range(3, 40))], "doc_id long, text string")
    # crc32 of 1 and 2 isn't in the held-out fold
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(1, 3)], "doc_id long, toxic int")
    one, two = toxicity.fit(docs.coalesce(1), labels), toxicity.fit(docs.repartition(7), labels)
    assert one.trigrams["zyz"] == 37 and one.trigrams == two.trigrams and one.trigrams["wor"] == 2


def test_toxicity_odd(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (5, 0), (5, 2), (99, 1), (None, 1)], "doc_id long, toxic int")
    found = both(odd_docs, no_docs, lambda d: toxicity.score(d, labels))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert toxicity.score(odd_docs, labels.filter("false")).count() == 9


# 10

def edits(a, b):
    """Edit distance, cell by cell."""
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(now[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_distance_against_brute_force():
    r = random.Random(1)
    for _ in range(3000):
        a = [r.randrange(6) for _ in range(r.randrange(30))]
        b = list(a)
        for _ in range(r.randrange(10)):
            b[(i := r.randrange(len(b) + 1)) : i + r.randrange(2)] = [r.randrange(6)] * r.randrange(2)
        most, d = r.randrange(20), edits(a, b)
        assert ordermin.distance(a, b, most) == min(d, most + 1)


def root(of, i):
    while of[i] != i:
        i = of[i]
    return i


def joined(ids, alike):
    """The least id of each id's class, over all pairs."""
    of = {i: i for i in ids}
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if alike(a, b):
                x, y = sorted((root(of, a), root(of, b)))
                of[y] = x
    return {i: root(of, i) for i in ids}


def test_near_duplicates_against_brute_force(docs, rows):
    own = {i: ordermin.words(t) for i, t in rows}

    def alike(a, b):
        x, y = own[a], own[b]
        long = max(len(x), len(y))
        if sum((Counter(x) & Counter(y)).values()) < 0.8 * long - 1e-9:
            return False
        return not long or 1 - edits(x, y) / long >= 0.8 - 1e-9

    got = {r.doc_id: r.class_id for r in ordermin.classes(docs).collect()}
    assert got == joined(sorted(own), alike)


def test_near_copies_are_found(spark):
    """Of copies with one word in twelve changed, moved in or left out at least nine tenths join their originals; nothing else does."""
    r = random.Random(12)
    rows = []
    for i in range(200):
        base = [f"w{r.randint(0, 3000)}" for _ in range(r.choice((60, 150, 400)))]
        copy = list(base)
        for _ in range(len(base) // 12):
            at, kind = r.randrange(len(copy)), r.randrange(3)
            copy[at : at + (kind != 1)] = [f"x{r.randint(0, 3000)}"] * (kind != 2)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    got = {x.doc_id: x.class_id for x in ordermin.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * i] == 2 * i and got[2 * i + 1] in (2 * i, 2 * i + 1) for i in range(200))
    assert sum(got[2 * i + 1] == 2 * i for i in range(200)) >= 180


def test_aligned_minds_order():
    h = lambda s: np.array([hash(w) & 0xFFFFFFFF for w in s.split()], np.uint32)
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"a{i}" for i in [*range(30, 60), *range(30)])
    assert ordermin.aligned(h(a), h(a)) == 1.0 and ordermin.aligned(h(a), h(b)) == 0.0 and ordermin.aligned(h(a), h("x y z")) == 0.0
    assert ordermin.aligned(h(a), h(a + " b")) == pytest.approx(60 / 61) and ordermin.aligned(h(""), h("")) == 1.0


def test_near_duplicates_hot_group(spark):
    """Hundreds of slightly different copies, and many equal ones, are one class."""
    r = random.Random(8)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(300)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(i % 4):
            w[r.randrange(300)] = f"x{r.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"u{r.randint(0, 10**6)}" for _ in range(50))) for i in range(20)]
    got = {x.doc_id: x.class_id for x in ordermin.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(300)) and all(got[i] == i for i in range(1000, 1020))


def test_near_duplicates_within_a_template(spark):
    """Pairs of near copies in buckets of many different texts are found, whoever leads the buckets."""
    r = random.Random(5)
    some = lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    page, rows = some(300), []
    for i in range(300):
        own = page[:150] + some(150) + page[150:]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join([*own[:200], "x", *own[201:]]))]
    got = {x.doc_id: x.class_id for x in ordermin.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(600)}


def test_bounds_lose_no_pair():
    r = random.Random(6)
    for _ in range(300):
        a = np.array([r.randrange(40) for _ in range(r.randint(1, 400))], np.uint64)
        b = a.copy()
        b[: r.randrange(len(a) // 4 + 1)] = 77
        b = b[r.randrange(len(b) // 9 + 1) :]
        x, y = (ordermin.binned(z, np.array([len(z)])) for z in (a, b))
        if ordermin.aligned(a, b):
            assert ordermin.possible(x, y, np.array([len(a)]), np.array([len(b)]), 0.8).all()


def test_links_within_buckets():
    """Links join all that is alike in a bucket, within a block or across blocks, without naming all pairs."""
    import pyarrow as pa

    n = 300
    words = [np.array([100 * (i % 5) + j for j in range(50)] + [9000 + i], np.uint32).tobytes() for i in range(n)]
    t = pa.table({"key": [i % 2 for i in range(n)], "node": list(range(n)), "class": list(range(n)), "own": [i % 3 for i in range(n)], "apart": [False] * n, "words": words})
    crossed = t.set_column(t.column_names.index("apart"), "apart", pa.array([True] * n))
    for table in (t, crossed):
        links = [(x["a"], x["b"]) for x in ordermin.within(table, 0.8).to_pylist()]
        of = {i: i for i in range(n)}
        for a, b in links:
            assert a % 10 == b % 10 and (table is t or a % 3 != b % 3)
            x, y = sorted((root(of, a), root(of, b)))
            of[y] = x
        assert {i: root(of, i) for i in of} == {i: i % 10 for i in range(n)} and len(links) == n - 10


def test_near_copies_meet_one_leader(spark, monkeypatch):
    """In a group of n near copies about n pairs are compared and about n links followed, not one for each of their sketches, and again after each step."""
    r = random.Random(4)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(60)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(1 + i % 3):
            w[r.randrange(60)] = f"x{r.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    met, followed = [], []
    verified, components = ordermin.verified, ordermin.components
    monkeypatch.setattr(ordermin, "verified", lambda pairs, *more: met.append(pairs.count()) or verified(pairs, *more))
    monkeypatch.setattr(ordermin, "components", lambda links: followed.append(links.count()) or components(links))
    got = {x.doc_id: x.class_id for x in ordermin.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(range(400), 0)
    assert 399 <= sum(followed) <= 440 and sum(met) <= 440, (met, followed)


def test_components_against_brute_force(spark):
    """Long chains, stars whose middle is the greatest or the least, links that repeat, and random ones."""
    r = random.Random(9)
    links = [(i, i + 1) for i in range(1500)] + [(2000 + i, 2999) for i in range(500)] + [(3000, 3001 + i) for i in range(500)] + [(2 * i, 2 * i + 2) for i in range(2000, 2300)][::-1]
    links += [tuple(r.sample(range(5000, 6000), 2)) for _ in range(600)] + links[:20]
    found = ordermin.components(spark.createDataFrame(links, "a long, b long")).collect()
    of = {i: i for link in links for i in link}
    for a, b in links:
        x, y = sorted((root(of, a), root(of, b)))
        of[y] = x
    assert len(found) == len(of) and {x["node"]: x["class"] for x in found} == {i: root(of, i) for i in of}


def test_near_duplicates_odd(odd_docs, no_docs):
    got = {r.doc_id: r.class_id for r in both(odd_docs, no_docs, ordermin.classes, 8)}  # one row a document
    assert got[1] == got[2] == got[3] == 1 and got[6] == 5 and got[7] == 7 and got[None] is None
    assert both(odd_docs, no_docs, ordermin.first_of_class, None) and ordermin.first_of_class(odd_docs).count() == 5


# the pipeline

def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert 0.5 * docs.count() < out.count() <= docs.count(), name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    pieces, _ = check_packing(rows)
    assert set(pieces) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SF).count() > 0
