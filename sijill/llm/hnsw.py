"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Different vectors are dealt to shards by their hash; equal ones share a node, which keeps the
smallest ids, as many as can be among the results. Each shard's graph is built once and stored
as flat arrays: vectors, neighbours by level, entry node. Blocks of queries search all graphs,
and the shards' results, measured anew in double precision, are merged.

Points are inserted, and queries searched, many at a time: each has its own beam, and each step
opens the nearest unopened nodes of all beams with array operations. Points of one batch also
consider each other.

Zero vectors take no part. Queries only meet vectors of their own length. Equal rows count
once; rows that share the query's vec_id are its own. An empty table gives no rows.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .vectors import best, blocks_of, by_length, matrix, over_blocks, shard_of, valid

EVERY, K = 100, 10
SHARD, LINKS, BUILD_BEAM, BEAM, BATCH, OPEN = 16384, 16, 80, 128, 256, 4
FAR = np.float32(np.inf)
#: Components are divided by the shard's greatest; below SMALL double precision is used.
SMALL, OUTSIDE = 1e-3, 1000.0


class Graph:
    def __init__(self, vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM):
        self.scale = float(np.abs(vectors).max(initial=0)) or 1.0
        scaled = vectors / self.scale
        narrow = np.abs(scaled).max(axis=1, initial=0).min(initial=1) >= SMALL  # else squares of small vectors would vanish in single precision
        self.vectors = np.ascontiguousarray(scaled, np.float32 if narrow else np.float64)
        self.links, self.beam = links, beam
        n = len(vectors)
        draw = np.random.default_rng(7)
        self.levels = np.minimum((-np.log(draw.random(n)) / np.log(links)).astype(int), 12)
        self.near = [np.full((n, 2 * links if level == 0 else links), -1, np.int32) for level in range(int(self.levels.max(initial=0)) + 1)]
        self.entry, done = -1, 0
        order = draw.permutation(n)
        while done < n:
            size = max(1, min(BATCH, done // 2, n - done))
            self.insert(order[done : done + size])
            done += size

    @classmethod
    def stored(cls, data: bytes) -> Graph:
        g, f = cls.__new__(cls), np.load(io.BytesIO(data))
        g.vectors, g.scale, g.entry, g.near = f["vectors"], float(f["scale"]), int(f["entry"]), []
        for i in range(int(f["depth"])):
            g.near.append(f[f"near{i}"])
        return g

    def flat(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, scale=self.scale, entry=self.entry, depth=len(self.near), **{f"near{i}": x for i, x in enumerate(self.near)})
        return out.getvalue()

    def distances(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each of its nodes; FAR where there is none."""
        gap = self.vectors[nodes] - points[:, None, :]
        d = np.einsum("ijk,ijk->ij", gap, gap)
        d[nodes < 0] = FAR
        return d

    def search(self, points: np.ndarray, starts: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each point: nodes, nearest first, and their squared distances."""
        w, n = len(points), len(self.vectors)
        nodes = np.full((w, beam), -1, np.int64)
        dist = np.full((w, beam), FAR, self.vectors.dtype)
        opened = np.ones((w, beam), bool)
        seen = np.zeros((w, n + 1), bool)  # the last column stands for no node
        seen[:, n] = True
        m = min(beam, starts.shape[1])
        nodes[:, :m], dist[:, :m] = starts[:, :m], self.distances(points, starts[:, :m])
        opened[:, :m] = starts[:, :m] < 0
        np.put_along_axis(seen, np.where(starts < 0, n, starts), True, 1)
        lanes = np.arange(w)
        while len(lanes):
            waiting = np.where(opened[lanes], FAR, dist[lanes])
            pick = np.argpartition(waiting, OPEN - 1, axis=1)[:, :OPEN] if beam > OPEN else np.argsort(waiting, axis=1)[:, :OPEN]
            worth = np.take_along_axis(waiting, pick, 1) < FAR
            go = worth.any(1)
            lanes, pick, worth = lanes[go], pick[go], worth[go]
            if not len(lanes):
                break
            opened[lanes[:, None], pick] = True
            at = np.where(worth, nodes[lanes[:, None], pick], -1)
            new = np.where(at[:, :, None] >= 0, self.near[level][at], -1).reshape(len(lanes), -1).astype(np.int64)
            new = np.where(new < 0, n, new)
            new[seen[lanes[:, None], new]] = n
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            seen[lanes[:, None], new] = True
            new[new == n] = -1
            all_nodes = np.concatenate([nodes[lanes], new], 1)
            all_dist = np.concatenate([dist[lanes], self.distances(points[lanes], new)], 1)
            all_opened = np.concatenate([opened[lanes], new < 0], 1)
            keep = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
            nodes[lanes], dist[lanes], opened[lanes] = (np.take_along_axis(x, keep, 1) for x in (all_nodes, all_dist, all_opened))
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)

    def chosen(self, nodes: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
        """Up to `most` of each row's nodes that are nearer to its point than to any chosen before; gaps are filled by the nearest others."""
        order = np.argsort(dist, axis=1, kind="stable")
        nodes, dist = np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)
        w, c = nodes.shape
        x = self.vectors[nodes]
        sq = np.einsum("ijk,ijk->ij", x, x)
        between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        kept = np.zeros((w, c), bool)
        number = np.zeros(w, int)
        for i in range(c):
            near = np.where(kept, between[:, i, :], FAR).min(1)
            take = (nodes[:, i] >= 0) & (number < most) & (dist[:, i] < near)
            kept[:, i] = take
            number += take
        place = np.where(kept, 0, np.where(nodes >= 0, 1, 2)) * c + np.arange(c)
        out = np.full((w, most), -1, np.int64)
        first = np.argsort(place, axis=1)[:, :most]
        out[:, : first.shape[1]] = np.take_along_axis(nodes, first, 1)
        return out

    def insert(self, batch: np.ndarray) -> None:
        if self.entry < 0:
            self.entry = int(batch[0])
            self.top = int(self.levels[self.entry])
            batch = batch[1:]
            if not len(batch):
                return
        points, own = self.vectors[batch], self.levels[batch]
        starts = np.full((len(batch), 1), self.entry, np.int64)
        for level in range(max(self.top, int(own.max())), -1, -1):
            if level > self.top:
                here = np.flatnonzero(own >= level)
                self.link(batch[here], np.full((len(here), 1), -1, np.int64), level)
                continue
            above = own < level
            nodes = np.full((len(batch), self.beam), -1, np.int64)
            if above.any():
                nodes[above, :1] = self.search(points[above], starts[above], level, 1 + OPEN)[0][:, :1]
            if not above.all():
                here = np.flatnonzero(~above)
                nodes[here] = self.search(points[here], starts[here], level, self.beam)[0]
                self.link(batch[here], nodes[here], level)
            starts = nodes
        if own.max() > self.top:
            self.entry, self.top = int(batch[own.argmax()]), int(own.max())

    def link(self, batch: np.ndarray, nodes: np.ndarray, level: int) -> None:
        """Chooses neighbours for the points of a batch, among the found nodes and each other, and links back."""
        near = self.near[level]
        points = self.vectors[batch]
        if len(batch) > 1:
            peers = np.tile(batch.astype(np.int64), (len(batch), 1))
            peers[np.arange(len(batch)), np.arange(len(batch))] = -1
            d = self.distances(points, peers)
            m = min(len(batch), self.links)
            nearest = np.argpartition(d, m - 1, axis=1)[:, :m]
            nodes = np.concatenate([nodes, np.take_along_axis(peers, nearest, 1)], 1)
        picked = self.chosen(nodes, self.distances(points, nodes), self.links)
        near[batch, : self.links] = picked
        target, source = picked.ravel(), np.repeat(batch, self.links)
        target, source = target[target >= 0], source[picked.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, int)
        ends = np.append(starts[1:], len(target))
        for a in range(0, len(starts), 1024):
            s, e = starts[a : a + 1024], ends[a : a + 1024]
            to = target[s]
            extra = np.full((len(s), int((e - s).max(initial=0))), -1, np.int64)
            row = np.repeat(np.arange(len(s)), e - s)
            extra[row, np.arange(e[-1] - s[0]) - np.repeat(s - s[0], e - s)] = source[s[0] : e[-1]]
            both = np.concatenate([near[to].astype(np.int64), extra], 1)
            both.sort(axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            near[to] = self.chosen(both, self.distances(self.vectors[to], both), near.shape[1])

    def nearest(self, points: np.ndarray, k: int, beam: int = BEAM) -> np.ndarray:
        """Nodes of up to k nearest vectors of each point, -1 where there are fewer."""
        out = []
        # points far outside stand at OUTSIDE times the shard's size in their direction, which keeps the order of its vectors
        size = np.abs(points).max(axis=1, initial=0, keepdims=True)
        points = np.where(size / OUTSIDE > self.scale, points / np.maximum(size, np.finfo(float).tiny) * OUTSIDE, points / self.scale)
        points = np.ascontiguousarray(points, self.vectors.dtype)
        for a in range(0, len(points), BATCH):
            some = points[a : a + BATCH]
            starts = np.full((len(some), 1), self.entry, np.int64)
            for level in range(len(self.near) - 1, 0, -1):
                starts = self.search(some, starts, level, 1 + OPEN)[0][:, :1]
            out.append(self.search(some, starts, 0, max(beam, k + 1))[0][:, :k])
        return np.concatenate(out)


def index(rows: DataFrame, shards: int, keep: int) -> DataFrame:
    """(shard, length, graph, vectors, ids): a graph for each shard and length of vectors; ids has up to `keep` for each node."""

    def few(batches):
        """Of equal vectors within a batch, the rows with the smallest ids."""
        import pyarrow as pa

        for batch in batches:
            ids, vectors = batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()
            groups: dict = {}
            for i in sorted(range(len(ids)), key=ids.__getitem__):
                groups.setdefault(tuple(vectors[i]), []).append(i)
            rows = [i for g in groups.values() for i in g[:keep]]
            yield batch.take(pa.array(sorted(rows), pa.int64()))

    def build(table):
        import pyarrow as pa

        out = {"shard": [], "length": [], "graph": [], "vectors": [], "ids": []}
        for length, some in by_length(table).items():
            ids, vectors = some.column("vec_id").to_numpy(), matrix(some.column("vector"))
            order = np.argsort(ids, kind="stable")
            different, node = np.unique(vectors[order] + 0.0, axis=0, return_inverse=True)
            members = np.full((len(different), keep), -1, np.int64)
            fill = np.zeros(len(different), int)
            for i, x in zip(ids[order].tolist(), node.ravel().tolist(), strict=True):
                if fill[x] < keep:
                    members[x, fill[x]] = i
                    fill[x] += 1
            out["shard"].append(table.column("shard")[0].as_py())
            out["length"].append(length)
            out["graph"].append(Graph(different).flat())
            out["vectors"].append(different.astype("<f8").tobytes())
            out["ids"].append(members.tobytes())
        return pa.table(out, schema=pa.schema([("shard", pa.int32()), ("length", pa.int32()), ("graph", pa.binary()), ("vectors", pa.binary()), ("ids", pa.binary())]))

    return (rows.mapInArrow(few, rows.schema).withColumn("shard", shard_of(F.col("vector"), shards))
            .groupBy("shard").applyInArrow(build, "shard int, length int, graph binary, vectors binary, ids binary"))


def search(vectors: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id is divisible by `every`."""
    rows = valid(vectors).filter(F.exists("vector", lambda x: x != 0))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    shards = max(1, -(-n.n // shard_rows))
    graphs = checkpointed(vectors.sparkSession, index(rows, shards, k + 1))
    queries, blocks = blocks_of(rows.filter(F.col("vec_id") % every == 0), shards, n.q)

    def run(stored, asked):
        import pyarrow as pa

        out, asked = [], by_length(asked)
        for shard in stored.to_pylist():
            if shard["length"] not in asked:
                continue
            some = asked[shard["length"]]
            graph, points = Graph.stored(shard["graph"]), matrix(some.column("vector"))
            whole = np.frombuffer(shard["vectors"], "<f8").reshape(len(graph.vectors), -1)
            members = np.frombuffer(shard["ids"], np.int64).reshape(len(whole), -1)
            for query_id, q, nodes in zip(some.column("query_id").to_pylist(), points, graph.nearest(points, k + 1), strict=True):
                nodes = nodes[nodes >= 0]
                d = np.sqrt(((whole[nodes] - q) ** 2).sum(1))
                ids = members[nodes]
                d = np.repeat(d, ids.shape[1])[(ids >= 0).ravel()]
                ids = ids[ids >= 0]
                d, ids = d[ids != query_id], ids[ids != query_id]
                keep = np.lexsort([ids, d])[:k]
                out += zip([query_id] * len(keep), ids[keep].tolist(), d[keep].tolist(), strict=True)
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    found = (over_blocks(graphs, blocks).groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
             .applyInArrow(run, "query_id long, vec_id long, score double"))
    return best(found, k, F.col("score"))
