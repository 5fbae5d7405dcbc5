"""Packing of token pieces into sequences: bounded-space best-fit, and best-fit-decreasing with whole id matrices.

Pieces are dealt into shards by a hash, many more than one shard only where there is much to pack, and each shard is
packed by itself, so no task grows with the input; a shard's last sequences are all that it may leave part empty.

Results for special cases: a null or empty text is its end id; repeated rows are packed each; a document with a null id
is packed like any other; of bins with equal room the one opened or filled last is taken online, the first one in the
decreasing form; texts of any length are cut into as many pieces as they need; an empty table gives an empty result;
other columns play no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shards
from .tokens import loaded, pieces


class BoundedBestFit:
    """At most ``open_bins`` open bins, in a bitset keyed by free space; a piece goes where the least space is left,
    and where a bin too many would be open, the fullest closes."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.open, self.bins = 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, length: int) -> tuple[int, int]:
        """The piece's bin and its place there."""
        fitting = self.bits >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            found = self.at[free].pop()
            if not self.at[free]:
                self.bits ^= 1 << free
        else:
            free, found = self.capacity, self.bins
            self.bins += 1
            self.open += 1
        rest = free - length
        if rest:
            self.at[rest].append(found)
            self.bits |= 1 << rest
        else:
            self.open -= 1
        if self.open > self.open_bins:
            fullest = (self.bits & -self.bits).bit_length() - 1
            self.at[fullest].pop()
            if not self.at[fullest]:
                self.bits ^= 1 << fullest
            self.open -= 1
        return found, self.capacity - free


class CapacityTree:
    """A segment tree over free spaces 0..capacity with the bins that have each; finds the least that is enough."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, free: int, found: int) -> None:
        heapq.heappush(self.bins[free], found)
        i = free + self.width
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The free space and the bin, which goes; None if no bin has room."""
        i = need + self.width
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up to the first subtree to the right with a bin
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.width:
                i *= 2
                if not self.count[i]:
                    i += 1
        free = i - self.width
        while i:
            self.count[i] -= 1
            i >>= 1
        return free, heapq.heappop(self.bins[free])


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and place of every length; the lengths must not increase."""
    tree, bins, out = CapacityTree(capacity), 0, []
    for n in lengths:
        free, found = tree.take(n) or (capacity, bins)
        bins += found == bins
        out.append((found, capacity - free))
        if free > n:
            tree.put(free - n, found)
    return out


def _shard(n: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)).cast("int")


def pack(found: DataFrame, n_shards: int, most: int = 1024, open_bins: int = 4096) -> DataFrame:
    """``found`` (pieces) with sequence_id and offset, by bounded-space best-fit, online: a shard's pieces come in the order of
    their documents (by the hash of the id, so that neighbours are not alike) and are placed for good one by one."""
    schema = found.schema

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["came", "doc_id", "piece", "ids_crc32"], kind="stable")
        bins = BoundedBestFit(most, open_bins)
        placed = np.array([bins.add(n) for n in frame["length"].tolist()], np.int64).reshape(-1, 2)
        shard = frame["shard"].astype(np.int64)
        return frame.drop(columns=["shard", "came"]).assign(sequence_id=shard * (1 << 40) + placed[:, 0], offset=placed[:, 1])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return found.withColumns({"shard": _shard(n_shards), "came": F.xxhash64("doc_id")}).groupBy("shard").applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, most: int = 1024, end_id: int = 2, path: str | None = None, shard_chars: int = 40_000_000, open_bins: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``."""
    n = shards(docs, F.length("text"), shard_chars)
    packed = pack(pieces(docs, most, end_id, path), n, most, open_bins)
    return packed.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def packed_matrices(docs: DataFrame, most: int = 1024, end_id: int = 2, pad_id: int = 0, path: str | None = None, shard_chars: int = 12_000_000, rows: int = 1) -> DataFrame:
    """Best-fit-decreasing sequences with all that a trainer reads, ``rows`` sequences to a row.

    sequence_id (of the first), n_rows, n_tokens; ids: the matrix, row by row, padded, as little-endian unsigned 16-bit
    integers if the vocabulary allows, else 32-bit (``id_bytes`` says which); positions: likewise, 16-bit, from 0 in every
    segment and in the padding; cu_seqlens: cumulative lengths of the segments from 0, padding being no segment;
    row_segments: how many segments each row has; doc_ids, pieces, starts: of each segment.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        width = 2 if loaded(path).size <= 1 << 16 else 4
        frame = frame.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        placed = np.array(best_fit_decreasing(frame["length"].tolist(), most), np.int64).reshape(-1, 2)
        order = np.lexsort((placed[:, 1], placed[:, 0]))
        bins, offsets = placed[order, 0], placed[order, 1]
        lengths, raw = frame["length"].to_numpy()[order], frame["ids"].to_numpy()[order]
        ids = frame["doc_id"].to_numpy()[order]
        piece, start = frame["piece"].to_numpy()[order], frame["start"].to_numpy()[order]
        base, out = int(frame["shard"].iloc[0]) << 40, []
        n_bins = int(bins[-1]) + 1
        first = np.searchsorted(bins, np.arange(n_bins + rows)).tolist()
        for b in range(0, n_bins, rows):
            n_rows = min(rows, n_bins - b)
            matrix = np.full((n_rows, most), pad_id, f"<u{width}")
            positions = np.zeros((n_rows, most), "<u2")
            positions[:] = np.arange(most)
            for k in range(first[b], first[b + n_rows]):
                r, at, n = int(bins[k]) - b, int(offsets[k]), int(lengths[k])
                matrix[r, at : at + n] = np.frombuffer(raw[k], f"<u{width}")
                positions[r, at : at + n] = np.arange(n)
            here = slice(first[b], first[b + n_rows])
            per_row = np.diff(first[b : b + n_rows + 1])
            for r in range(n_rows):
                used = int(lengths[first[b + r] : first[b + r + 1]].sum())
                positions[r, used:] = np.arange(most - used)
            out.append((base + b, n_rows, int(lengths[here].sum()), width, matrix.tobytes(), positions.tobytes(), np.concatenate(([0], np.cumsum(lengths[here]))), per_row, ids[here].tolist(), piece[here], start[here]))
        return pd.DataFrame(out, columns=["sequence_id", "n_rows", "n_tokens", "id_bytes", "ids", "positions", "cu_seqlens", "row_segments", "doc_ids", "pieces", "starts"])

    n = shards(docs, F.length("text"), shard_chars)
    found = pieces(docs, most, end_id, path, with_ids=True, narrow=True)
    schema = "sequence_id long, n_rows int, n_tokens long, id_bytes int, ids binary, positions binary, cu_seqlens array<int>, row_segments array<int>, doc_ids array<string>, pieces array<int>, starts array<long>"
    packed = found.withColumn("shard", _shard(n)).groupBy("shard").applyInPandas(run, schema)
    return packed.withColumn("doc_ids", F.col("doc_ids").cast(f"array<{kind}>"))


def write_matrices(docs: DataFrame, folder: str, rows: int = 256, **options) -> None:
    """Matrices of ``rows`` sequences each, written as Parquet with binary columns; any store that Spark can write."""
    packed_matrices(docs, rows=rows, **options).write.mode("overwrite").parquet(folder)


def query_best_fit(docs: DataFrame) -> DataFrame:
    """The rows of ``op4_best_fit_packing``."""
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def query_matrices(docs: DataFrame) -> DataFrame:
    """The rows of ``op9_token_output``: a sequence each."""
    return packed_matrices(docs)
