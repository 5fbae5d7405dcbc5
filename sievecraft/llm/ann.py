"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Equal vectors are one node with its least ids, as many as a query can need, so that a vector with very many copies
neither fills a shard nor tears its graph.  Shards are of bounded size, dealt by a hash of the vector; each shard's graph
is flat arrays (vectors, neighbour slots by level), written once.  The walk takes differences in double precision, after a
division by a power of two, so neither far origins nor very large or small numbers change what is near.  Each graph goes
to one task; the queries follow it there in blocks, as a stream, so a task holds a graph and a few blocks whatever their
number.  Each shard gives its nearest, and the nearest of all are ranked by the distance of the vectors as they are.
Every query is asked of every shard: its cost is the number of shards times a walk that grows with the logarithm of their
size, so at scale shards should be as large as a task's memory and time allow (``shard_size``).

Results for special cases: vectors that are null, zero, or have null or non-finite components take no part, neither
have queries of other lengths than a candidate's; a row with a null id takes no part; repeated rows count once; equal
distances go to the smaller id; an empty table, or one vector alone, gives an empty result; other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved


def _scale(vectors: np.ndarray) -> float:
    """A power of two by which no component is above one: dividing by it rounds nothing."""
    most = float(np.abs(vectors).max()) if vectors.size else 0.0
    return 2.0 ** min(1000, math.frexp(most)[1]) if most else 1.0


class HNSW:
    """The graph over the rows of ``vectors``; ``links[level]`` has a row of slots for each node of that level (-1: free),
    ``rows[level]`` the row of each node (-1: none)."""

    def __init__(self, vectors: np.ndarray, m: int = 12, ef: int = 64, seed: int = 7) -> None:
        self._hold(vectors)
        n = len(vectors)
        self.m, self.ef = m, ef
        draws = np.random.default_rng(seed).random(n)
        self.levels = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(m)).astype(np.int64), 8)
        self.top = int(self.levels.max()) if n else 0
        self.rows, self.links = [], []
        for level in range(self.top + 1):
            there = np.flatnonzero(self.levels >= level)
            row = np.full(n, -1, np.int32)
            row[there] = np.arange(len(there))
            self.rows.append(row)
            self.links.append(np.full((len(there), 2 * m if level == 0 else m), -1, np.int32))
        self.entry, self.entry_level = -1, -1
        for i in range(n):
            self._insert(i)

    def _hold(self, vectors: np.ndarray) -> None:
        self.scale = _scale(vectors)
        self.vectors = np.ascontiguousarray(vectors / self.scale, np.float64)
        self.seen, self.visit = np.zeros(len(vectors), np.int64), 0

    def _distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        apart = self.vectors[nodes] - q
        return np.einsum("ij,ij->i", apart, apart)

    def _walk(self, q: np.ndarray, start: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest found from ``start``, as (distance, node), nearest first."""
        self.visit += 1
        visit, seen, links, rows = self.visit, self.seen, self.links[level], self.rows[level]
        heap = list(start)
        heapq.heapify(heap)
        best = [(-d, i) for d, i in start]
        heapq.heapify(best)
        for _, i in start:
            seen[i] = visit
        while heap:
            d, i = heapq.heappop(heap)
            if len(best) >= ef and d > -best[0][0]:
                break
            near = links[rows[i]]
            near = near[near >= 0]
            near = near[seen[near] != visit]
            if not len(near):
                continue
            seen[near] = visit
            ds = self._distances(q, near)
            worst = -best[0][0] if len(best) >= ef else np.inf
            for x, j in zip(ds.tolist(), near.tolist()):
                if x < worst or len(best) < ef:
                    heapq.heappush(heap, (x, j))
                    if len(best) < ef:
                        heapq.heappush(best, (-x, j))
                    else:
                        heapq.heappushpop(best, (-x, j))
                    worst = -best[0][0]
        return sorted((-d, i) for d, i in best)

    def _diverse(self, q: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
        """Nearest first, leaving out what is nearer to one already taken; filled up with the nearest left out."""
        if len(found) <= most:
            return [i for _, i in found]
        nodes = np.array([i for _, i in found])
        v = self.vectors[nodes] - q  # from here, where all are near, products lose nothing that counts
        s = np.einsum("ij,ij->i", v, v)
        between = s[:, None] + s[None, :] - 2.0 * (v @ v.T)
        taken: list[int] = []
        least = np.full(len(nodes), np.inf)
        for k, (d, _) in enumerate(found):
            if d < least[k]:
                taken.append(k)
                np.minimum(least, between[k], out=least)
                if len(taken) == most:
                    break
        if len(taken) < most:
            held = set(taken)
            taken += [k for k in range(len(nodes)) if k not in held][: most - len(taken)]
        return nodes[taken].tolist()

    def _insert(self, i: int) -> None:
        level = int(self.levels[i])
        q = self.vectors[i]
        if self.entry < 0:
            self.entry, self.entry_level = i, level
            return
        near = [(float(self._distances(q, np.array([self.entry]))[0]), self.entry)]
        for at in range(self.entry_level, level, -1):
            near = self._walk(q, near[:1], 1, at)
        for at in range(min(level, self.entry_level), -1, -1):
            near = self._walk(q, near, self.ef, at)
            links, rows = self.links[at], self.rows[at]
            own = self._diverse(q, near, self.m)
            links[rows[i], : len(own)] = own
            for j in own:
                slots = links[rows[j]]
                free = np.flatnonzero(slots < 0)
                if len(free):
                    slots[free[0]] = i
                    continue
                all_ = np.append(slots, i)
                ds = self._distances(self.vectors[j], all_)
                order = np.argsort(ds, kind="stable")
                kept = self._diverse(self.vectors[j], list(zip(ds[order].tolist(), all_[order].tolist())), len(slots))
                slots[:] = -1
                slots[: len(kept)] = kept
        if level > self.entry_level:
            self.entry, self.entry_level = i, level

    def search(self, q: np.ndarray, k: int, ef: int) -> list[int]:
        """About the k nearest nodes."""
        if self.entry < 0:
            return []
        q = np.asarray(q, np.float64) / self.scale
        near = [(float(self._distances(q, np.array([self.entry]))[0]), self.entry)]
        for at in range(self.entry_level, 0, -1):
            near = self._walk(q, near[:1], 1, at)
        return [i for _, i in self._walk(q, near, max(ef, k), 0)[:k]]

    def flat(self) -> list[bytes]:
        """Entry and levels, and the neighbour arrays, as bytes."""
        head = np.array([self.entry, self.entry_level, self.m, len(self.vectors)], "<i4")
        return [head.tobytes(), self.levels.astype("<i4").tobytes(), *(x.astype("<i4").tobytes() for x in self.links)]

    @classmethod
    def of_flat(cls, vectors: np.ndarray, parts: list[bytes]) -> HNSW:
        out = cls.__new__(cls)
        out._hold(vectors)
        entry, top, m, n = np.frombuffer(parts[0], "<i4").tolist()
        out.entry, out.entry_level, out.m, out.top = entry, top, m, len(parts) - 3
        out.levels = np.frombuffer(parts[1], "<i4")
        out.rows, out.links = [], []
        for level, raw in enumerate(parts[2:]):
            there = np.flatnonzero(out.levels >= level)
            row = np.full(n, -1, np.int32)
            row[there] = np.arange(len(there))
            out.rows.append(row)
            out.links.append(np.frombuffer(raw, "<i4").reshape(len(there), 2 * m if level == 0 else m))
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def nodes(found: DataFrame, k: int) -> DataFrame:
    """v, ids: each vector once, with its k + 1 least ids, which is all that the k nearest of a query other than these
    (or but one of these) can hold."""
    ranked = found.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).dropDuplicates(["vec_id", "v"])  # -0.0 is 0.0
    ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def index(found: DataFrame, n_shards: int, m: int, ef: int) -> DataFrame:
    """shard, ids, vectors (flat array<double>), dims, graph (array<binary>)."""

    def build(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        shard = int(frame["shard"].iloc[0])
        for dims, part in frame.groupby(frame["v"].map(len)):
            part = part.assign(first=part["ids"].map(lambda x: x[0])).sort_values("first")
            vectors = np.stack(part["v"].to_list()).astype(np.float64)
            yield pd.DataFrame({"shard": [shard], "dims": [int(dims)], "ids": [part["ids"].map(list).to_list()], "vectors": [vectors.astype("<f8").tobytes()], "graph": [HNSW(vectors, m, ef).flat()]})

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(list(build(frame)), ignore_index=True)

    dealt = found.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(n_shards)).cast("int"))
    # a shard to a task: by range, as few hashes of shards would share tasks, and small shards would be put together
    return dealt.repartitionByRange(n_shards, "shard").groupBy("shard").applyInPandas(one, "shard int, dims int, ids array<array<long>>, vectors binary, graph array<binary>")


def _search_shards(tasks: DataFrame, k: int, ef: int) -> DataFrame:
    """tasks: for each shard its graphs (place -1), then blocks of queries, in this order.  Each graph's nearest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, graphs = None, []
        for frame in frames:
            out: list[tuple] = []
            for at, dims, ids, raw, graph, asked in zip(*(frame[c] for c in ("shard", "dims", "ids", "vectors", "graph", "asked"))):
                if at != shard:
                    shard, graphs = at, []
                if raw is not None:
                    exact = np.frombuffer(raw, "<f8").reshape(-1, int(dims))
                    graphs.append((int(dims), ids, exact, HNSW.of_flat(exact, list(graph))))
                    continue
                for row in asked:
                    q = np.asarray(row["v"], np.float64)
                    for length, names, exact, hnsw in graphs:
                        if len(q) != length:
                            continue
                        near = np.array(hnsw.search(q, ef, ef), np.int64)
                        with np.errstate(over="ignore"):
                            scores = np.sqrt(((exact[near] - q) ** 2).sum(1))
                        hits = sorted((s, int(i)) for s, n in zip(scores.tolist(), near.tolist()) for i in names[n] if i != row["vec_id"])
                        out += [(row["vec_id"], i, s) for s, i in hits[:k]]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return tasks.mapInPandas(run, "query_id long, vec_id long, score double")


def search(vectors: DataFrame, k: int = 10, every: int = 100, shard_size: int = 10_000, m: int = 16, ef_build: int = 100, ef: int = 200, block: int = 32) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``."""
    found = usable(vectors)
    distinct = saved(nodes(found, k))
    n_shards = max(1, -(-distinct.count() // shard_size))
    graphs = saved(index(distinct, n_shards, m, ef_build))

    queries = found.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    blocks = max(1, -(-queries.count() // block))
    asked = queries.withColumn("place", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asked = asked.groupBy("place").agg(F.collect_list(F.struct("vec_id", "v")).alias("asked"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    tasks = graphs.withColumn("place", F.lit(-1).cast("long")).unionByName(asked, allowMissingColumns=True)
    tasks = tasks.repartitionByRange(n_shards, "shard").sortWithinPartitions("shard", "place")
    hits = _search_shards(tasks, k, ef)
    best = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # an id with several vectors counts once
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(vectors: DataFrame) -> DataFrame:
    """The rows of ``op3_nearest_neighbours``."""
    return search(vectors)
