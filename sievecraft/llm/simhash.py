"""SimHash fingerprints and near-duplicate groups by sharded BK-trees.

Fingerprints within ``radius`` bits agree in at least r of radius + r blocks of bits, whatever r; so each choice of r
blocks deals the fingerprints into shards by the bits of those blocks, and every link lies in some shard.  In a shard a
BK-tree (children keyed by their Hamming distance to the parent) is searched along the edges within the radius.  A
shard larger than ``tree_size`` is cut into parts, and each pair of parts gets a task in which the tree of one part is
searched for the members of the other; trees are thus bounded whatever shares a shard.  Each task unites what it links
and returns a star of each group, never the pairs.

The pipeline's stage links texts by the share of their shingles (``similar_groups``).

Results for special cases: a null or empty text, or one without words, has fingerprint zero and is linked like any
other; repeated rows get a row each; the component id is the least non-null id reached (null if there is none), the
smaller of tied ones; texts of any length are read whole, each by itself; an empty table gives an empty result; other
columns play no part in the query and pass through ``stage`` untouched, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_unique, packed, saved, unpacked
from .components import components

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = np.arange(8) * 256


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words of the lower-cased text; of all words, if they are fewer."""
    words = text.lower().split()  # bytes: A-Z, and white space as in the contracts
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -size])).tolist()
    pieces = [joined[a:b] for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, pieces, repeat(42))), ">u8").astype("<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, each set if more than half of the hashes have it; as a signed integer."""
    if not len(hashes):
        return 0
    lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANES
    counts = (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 4, text: str = "text") -> DataFrame:
    """doc_id, fp of every row of ``docs``."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes((t or "").encode(), size)) for t in texts], dtype="int64")

    return docs.select("doc_id", fp(F.coalesce(text, F.lit(""))).alias("fp"))


class BKTree:
    """A tree of 64-bit integers; a node is [value, {distance: node}]."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            v, children = stack.pop()
            d = (v ^ value).bit_count()
            if d <= radius:
                found.append(v)
            if children:
                low, high = d - radius, d + radius
                stack += [child for edge, child in children.items() if low <= edge <= high]
        return found


class Union:
    """Union-find whose roots are the least members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        p = self.parent.setdefault(x, x)
        while p != self.parent[p]:
            self.parent[p] = p = self.parent[self.parent[p]]
        self.parent[x] = p
        return p

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def block_masks(bits: int, radius: int, r: int) -> list[int]:
    """A mask for each choice of r of radius + r blocks."""
    cuts = [bits * i // (radius + r) for i in range(radius + r + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, r)]


def choose_masks(n: int, radius: int, per_row: float = 40.0) -> list[int]:
    """The cheapest masks for n fingerprints: a row in a shard costs ``per_row`` visits besides its tree's."""
    best = min((1, 2, 3), key=lambda r: math.comb(radius + r, r) * (per_row + 0.6 * n * 2.0 ** -(64 * r // (radius + r))))
    return block_masks(64, radius, best)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _stars(keys: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """keys: shard_a, shard_b (the shard), fp, id.  u, v: the ids linked within the radius in each shard, as stars."""
    sizes = keys.groupBy("shard_a", "shard_b").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("shard_a").alias("a"), F.col("shard_b").alias("b"), F.ceil(F.col("n") / tree_size).cast("int").alias("parts"))
    dealt = keys.join(sizes, (F.col("shard_a") == F.col("a")) & (F.col("shard_b") == F.col("b")))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("shard_a", "shard_b", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "fp", "id")
    dealt = dealt.repartition("shard_a", "shard_b", "low", "high").sortWithinPartitions("shard_a", "shard_b", "low", "high", "part", "id")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, tree, ids, union = None, BKTree(), {}, Union()
        out = _Stars()
        for batch in batches:
            columns = (batch[c].tolist() for c in ("shard_a", "shard_b", "low", "high", "part", "fp", "id"))
            for shard_a, shard_b, low, high, part, fp, id_ in zip(*columns):
                if (shard_a, shard_b, low, high) != group:
                    out.add(union)
                    group, tree, ids, union = (shard_a, shard_b, low, high), BKTree(), {}, Union()
                value = fp & 0xFFFFFFFFFFFFFFFF
                if low == high or part == high:
                    for x in tree.within(value, radius):
                        union.join(id_, ids[x])
                if part == low and ids.setdefault(value, id_) == id_:
                    tree.add(value)
            yield from out.full()
        out.add(union)
        yield out.frame()

    return dealt.mapInPandas(link, "u long, v long")


class _Stars:
    """Edges from the members of groups to their least, gathered for output."""

    def __init__(self) -> None:
        self.u: list[int] = []
        self.v: list[int] = []

    def add(self, union: Union) -> None:
        for x in list(union.parent):
            if (root := union.find(x)) != x:
                self.u.append(x)
                self.v.append(root)

    def full(self, most: int = 50_000) -> Iterator[pd.DataFrame]:
        if len(self.u) > most:
            yield self.frame()

    def frame(self) -> pd.DataFrame:
        out = pd.DataFrame({"u": self.u, "v": self.v}, dtype="int64")
        self.u, self.v = [], []
        return out


def stars(nodes: DataFrame, masks: list[int], radius: int, tree_size: int = 4096) -> DataFrame:
    """u, v: for every shard, its groups of fingerprints linked within the radius, as stars around the least."""
    each = F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("shard_a"), F.col("fp").bitwiseAND(_signed(m)).alias("shard_b")) for i, m in enumerate(masks))))
    return _stars(nodes.select("fp", each.alias("s")).select("s.*", "fp", F.col("fp").alias("id")), radius, tree_size)


def groups(prints: DataFrame, radius: int = 4, masks: list[int] | None = None, tree_size: int = 4096) -> DataFrame:
    """fp, n (rows that have it), low (their least id), component_id of every distinct fingerprint of ``prints`` (doc_id, fp)."""
    nodes = saved(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")))
    roots = components(stars(nodes, masks or choose_masks(nodes.count(), radius), radius, tree_size))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "n", "low", F.coalesce("root", "fp").alias("root"))
    ids = saved(rooted.groupBy(F.col("root").alias("of")).agg(F.min("low").alias("component_id"), F.count("*").alias("members")))
    return join_unique(rooted, "root", ids, "of", "members").select("fp", "n", "low", "component_id")


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs``."""
    prints = saved(fingerprints(docs, size))
    found = saved(groups(prints, radius).select(F.col("fp").alias("of"), "n", "component_id"))
    return join_unique(prints, "fp", found, "of", "n").select("doc_id", "fp", "component_id")


# --- groups by the share of common shingles


def _permutations(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def min_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    a, b = _permutations(n)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4096):  # a block stays in the cache
        part = hashes[i : i + 4096]
        for k in range(n):
            least[k] = min(least[k], (part * a[k] + b[k]).min())
    return least


def band_keys(least: np.ndarray, bands: int) -> list[int]:
    """A key for each band of min-hashes: two sets share one with the chance of their similarity to the power of its rows."""
    return [int(x) for x in np.frombuffer(b"".join(xxhash.xxh64_digest(band.tobytes()) for band in least.reshape(bands, -1)), "<i8")]


def _contents(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, raw (a hash of the text), content (of the lower-cased words), fp, bands, marks (a byte of each min-hash) of every row."""

    @F.pandas_udf("struct<content binary, fp long, bands array<long>, marks binary>")
    def of(texts: pd.Series) -> pd.DataFrame:
        out, seen = [], {}
        for t in texts:
            raw = t.encode().lower()
            content = xxhash.xxh3_128_digest(b" ".join(raw.split()))
            if content not in seen:
                distinct = np.unique(shingle_hashes(raw, size))  # as the similarity is that of sets
                least = min_hashes(distinct, bands * rows)
                seen[content] = (fingerprint(distinct), band_keys(least, bands), (least >> np.uint64(32)).astype(np.uint8).tobytes())
            out.append((content, *seen[content]))
        return pd.DataFrame(out, columns=["content", "fp", "bands", "marks"])

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("raw"), of(text).alias("x")).select("doc_id", "raw", "x.*")


def _candidates(keys: DataFrame, marks: DataFrame, radius: int, least_equal: int, part_size: int) -> DataFrame:
    """keys: band, key, fp, id; marks: of, marks.  u, v: what each band's shards hold to be alike, as stars: fingerprints
    within the radius, found by BK-trees, and so many equal min-hashes."""
    sizes = keys.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("band").alias("a"), F.col("key").alias("b"), F.ceil(F.col("n") / part_size).cast("int").alias("parts"))
    dealt = keys.join(sizes, (F.col("band") == F.col("a")) & (F.col("key") == F.col("b"))).join(marks, F.col("id") == F.col("of"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("band", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "fp", "id", "marks")
    dealt = dealt.repartition("band", "key", "low", "high").sortWithinPartitions("band", "key", "low", "high", "part", "id")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, union, out = None, Union(), _Stars()
        tree, places, ids, table = BKTree(), {}, [], np.zeros((0, 0), np.uint8)
        for batch in batches:
            for band, key, low, high, part, fp, id_, raw in zip(*(batch[c].tolist() for c in ("band", "key", "low", "high", "part", "fp", "id", "marks"))):
                own = np.frombuffer(raw, np.uint8)
                if (band, key, low, high) != group:
                    out.add(union)
                    group, union = (band, key, low, high), Union()
                    tree, places, ids, table = BKTree(), {}, [], np.zeros((4, len(own)), np.uint8)
                value = fp & 0xFFFFFFFFFFFFFFFF
                if ids and (low == high or part == high):
                    near = np.array([k for x in tree.within(value, radius) for k in places[x]], np.int64)
                    for k in near[(table[near] == own).sum(1) >= least_equal].tolist():
                        union.join(id_, ids[k])
                if part == low:
                    if value not in places:
                        places[value] = []
                        tree.add(value)
                    places[value].append(len(ids))
                    if len(ids) == len(table):
                        table = np.concatenate((table, np.zeros_like(table)))
                    table[len(ids)] = own
                    ids.append(id_)
            yield from out.full()
        out.add(union)
        yield out.frame()

    return dealt.mapInPandas(link, "u long, v long")


_HASH = 6  # bytes of a shingle's hash that are sent


def _shingle_set(size: int):
    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        sets = (np.unique(shingle_hashes(t.encode(), size)) for t in texts)
        return pd.Series([x.view(np.uint8).reshape(-1, 8)[:, :_HASH].tobytes() for x in sets], dtype=object)

    return of


def _alike(members: DataFrame, similarity: float, part_size: int) -> DataFrame:
    """members: root, n (how many share it), id, own (its set of shingles).  u, v: those of one root whose sets are alike,
    as stars.

    Roots with many members are cut into parts, and every pair of parts is compared in a task of its own.
    """
    dealt = members.withColumn("parts", F.ceil(F.col("n") / part_size).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("root", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "id", "own")
    dealt = dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "part", "id")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, union, out = None, Union(), _Stars()
        held: dict[int, list[int]] = {}  # of the part that is searched: shingle to places
        ids: list[int] = []
        sizes: list[int] = []
        last = None
        for batch in batches:
            for root, low, high, part, id_, raw in zip(*(batch[c].tolist() for c in ("root", "low", "high", "part", "id", "own"))):
                if (root, low, high) != group:
                    out.add(union)
                    group, union, held, ids, sizes = (root, low, high), Union(), {}, [], []
                elif id_ == last:  # rows that repeat
                    continue
                last = id_
                wide = np.zeros((len(raw) // _HASH, 8), np.uint8)
                wide[:, :_HASH] = np.frombuffer(raw, np.uint8).reshape(-1, _HASH)
                own = wide.view("<u8").ravel().tolist()
                if ids and (low == high or part == high):
                    places = [held[h] for h in own if h in held]
                    if places:
                        common = np.bincount(np.concatenate([np.array(p) for p in places]), minlength=len(ids))
                        for k in np.flatnonzero(common >= similarity * (len(own) + np.array(sizes) - common) - 1e-9).tolist():
                            union.join(id_, ids[k])
                if part == low:
                    for h in own:
                        held.setdefault(h, []).append(len(ids))
                    ids.append(id_)
                    sizes.append(len(own))
            yield from out.full()
        out.add(union)
        yield out.frame()

    return dealt.mapInPandas(link, "u long, v long")


def similar_groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, radius: int = 28, bands: int = 20, rows: int = 4, least_equal: int = 46, tree_size: int = 4096, part_size: int = 1000) -> DataFrame:
    """content, n_rows, id, component_id of every distinct content (lower-cased words) of ``docs``; of each component that
    with the least document id leads.

    Two contents are linked if their sets of ``size``-word shingles have at least ``similarity`` in common (of those in
    either).  All that share a band of min-hashes are a shard; its BK-trees find the fingerprints within the radius, and of
    these those are candidates that have ``least_equal`` of all min-hashes in common.  Only groups of candidates bring
    their sets of shingles together, as hashes, never as texts, and these decide what is linked.

    What a link at exactly 0.8 can be missed by: the bands with probability 3 in 100,000; the radius 1.1 in a million at
    most (fingerprints are of the sets too: a bit differs with probability 3/16 at most, four shingles of five); the
    equal min-hashes 1.3 in a million.
    """
    found = saved(_contents(docs, size, bands, rows))
    # a content's id is its least document id; one without any, or whose id other contents have too, gets a number of its own
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "raw")).alias("least")
    contents = found.groupBy("content").agg(least, F.count("*").alias("n_rows"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    contents = contents.withColumns({"low": F.col("least.doc_id"), "raw": F.col("least.raw")}).drop("least")
    nodes = saved(contents.withColumn("id", F.coalesce(F.col("low").cast("long"), F.xxhash64("content"))))
    twice = saved(nodes.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("id").alias("taken")))
    if not twice.isEmpty():
        own = F.when(F.col("taken").isNull(), F.col("id")).otherwise(F.xxhash64("content"))
        nodes = saved(nodes.join(twice, F.col("id") == F.col("taken"), "left").withColumn("id", own).drop("taken"))
    keys = nodes.select(F.posexplode("bands").alias("band", "key"), "fp", "id")
    near = components(_candidates(keys, nodes.select(F.col("id").alias("of"), "marks"), radius, least_equal, tree_size))
    near = saved(near.union(near.select("root", "root").distinct()))
    sizes = near.groupBy(F.col("root").alias("of")).agg(F.count("*").alias("n"))
    met = near.join(sizes, F.col("root") == F.col("of")).select("node", "root", "n")
    met = met.join(nodes.select("id", "low", "raw"), F.col("node") == F.col("id")).select("root", "n", "id", F.col("low").alias("its_low"), F.col("raw").alias("its_raw"))
    # the text of one row of each content: that of its least id; rows that repeat are the same text
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    members = texts.join(met, F.col("doc_id").eqNullSafe(F.col("its_low")) & (F.xxhash64("text") == F.col("its_raw"))).select("root", "n", "id", _shingle_set(size)("text").alias("own"))
    alike = components(_alike(members, similarity, part_size))
    rooted = nodes.join(alike.withColumnRenamed("root", "to"), nodes["id"] == F.col("node"), "left").select("content", "n_rows", "low", "id", F.coalesce("to", "id").alias("root"))
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "content")).alias("first")
    ids = saved(rooted.groupBy(F.col("root").alias("of")).agg(first, F.count("*").alias("members")))
    joined = join_unique(rooted, "root", ids, "of", "members")
    return joined.select("content", "n_rows", "low", "id", "root", F.col("first.low").alias("component_id"), (F.col("content") == F.col("first.content")).alias("leads"))


def stage(docs: DataFrame) -> DataFrame:
    """One document of each group of similar documents: that with the least id."""
    groups = saved(similar_groups(docs))
    kept = groups.filter("leads").select(F.col("content").alias("kept_content"), F.col("low").alias("kept_low"), "n_rows")

    @F.pandas_udf("binary")
    def content(texts: pd.Series) -> pd.Series:
        return pd.Series([xxhash.xxh3_128_digest(b" ".join(t.encode().lower().split())) for t in texts], dtype=object)

    # never null, so that the join needs no filter on it, which would run the function a second time
    out = packed(docs).withColumn("own_content", F.coalesce(content(F.coalesce("row_.text", F.lit(""))), F.lit(b"")))
    out = out.join(kept, (F.col("own_content") == F.col("kept_content")) & F.col("doc_id").eqNullSafe(F.col("kept_low")))
    # rows with the same id and content are left by repeats only; they are split off, so that the rest isn't shuffled
    single = out.filter("n_rows = 1").select("row_")
    repeated = out.filter("n_rows > 1").dropDuplicates(["own_content"]).select("row_")
    return unpacked(single.union(repeated), docs.columns)


def hex16(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def query(docs: DataFrame) -> DataFrame:
    """The rows of ``op1_simhash``."""
    return near_duplicates(docs).select("doc_id", hex16("fp").alias("fingerprint"), "component_id")
