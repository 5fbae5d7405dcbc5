"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

All new pre-tokens of a batch stand in one linked list of byte positions, with gaps between them.  Each merge rank has a
bucket of the positions whose pair has that rank; a bitmap of several levels over the ranks gives the least rank that has
a bucket by find-first-set.  Its positions are merged at once, entries whose pair has changed meanwhile are skipped, and
the new pairs go to the buckets of their ranks.  A pre-token of a million bytes thus costs no more a byte than short ones.

Merging all pairs of a rank at once equals the order of one pre-token at a time (least rank, then leftmost) as long as no
merge makes a pair of a lower rank; where one would, only each pre-token's leftmost pair is merged in that step.

Results for special cases: a null or empty text has no ids; rows are encoded one by one, so repeated rows and null ids
get their row each; of pairs of equal rank the leftmost goes first; texts of any length are encoded whole; an empty table
gives an empty result; other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as Unicode has it; the ``regex`` module's \s also takes U+001C to U+001F.
_UNICODE_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class RankQueue:
    """Buckets of positions by rank; the least rank that has a bucket is found through bitmaps of 64 bits a word."""

    def __init__(self, ranks: int) -> None:
        self.buckets: list[list[int] | None] = [None] * ranks
        self.levels: list[list[int]] = []
        while True:
            ranks = -(-ranks // 64)
            self.levels.append([0] * ranks)
            if ranks <= 1:
                return

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets[rank]
        if bucket is not None:
            bucket.extend(positions)
            return
        self.buckets[rank] = positions
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            filled = level[word]
            level[word] = filled | bit
            if filled:
                return
            rank = word

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank and its bucket, which goes."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << 6 | ((word & -word).bit_length() - 1)
        bucket, self.buckets[rank], at = self.buckets[rank], None, rank
        for level in self.levels:
            level[at >> 6] &= ~(1 << (at & 63))
            if level[at >> 6]:
                break
            at >>= 6
        return rank, bucket


class BPE:
    """An encoding given by the ranks of its tokens and the pattern of its pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = 300_000) -> None:
        self.ranks, self.cached = ranks, cached
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{_UNICODE_SPACE}").replace(r"\S", f"[^{_UNICODE_SPACE}]").replace(r"\s", f"[{_UNICODE_SPACE}]"))
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], -1)
        #: Tokens that are in a pair of a lower rank than their own.
        self.lower = np.zeros(self.size, bool)
        for side in (keys // self.size, keys % self.size):
            self.lower[side[self.pair_ranks[: len(keys)][np.argsort(order)] < side]] = True
        self.cache: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> BPE:
        """Ranks from a file of lines "base64-token rank"."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}, pattern)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def _makes_lower(self, rank: int, tok: np.ndarray, before: np.ndarray, after: np.ndarray, chosen: np.ndarray) -> bool:
        """Whether a chosen pair, merged to ``rank``, would make a pair of a lower rank with a neighbour, merged or not."""
        left, beyond = before[chosen], after[after[chosen]]
        left, beyond = tok[left[left >= 0]], tok[beyond[beyond >= 0]]
        new = np.concatenate((self.pair_rank(left, np.full(len(left), rank)), self.pair_rank(np.full(len(beyond), rank), beyond), self.pair_rank(np.array([rank]), np.array([rank]))))
        return bool(((new >= 0) & (new < rank)).any())

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (not empty), as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(sizes.sum())
        tok = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        ends = np.cumsum(sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        piece = np.repeat(np.arange(len(pieces)), sizes)
        rank_at = np.full(n, -1, np.int64)
        queue = RankQueue(self.size)

        def push(at: np.ndarray) -> None:
            """Sets the ranks of the pairs that begin at ``at`` (each once) and puts them into the queue."""
            right = after[at]
            ranks = np.where(right >= 0, self.pair_rank(tok[at], tok[right]), -1)
            rank_at[at] = ranks
            good = ranks >= 0
            at, ranks = at[good], ranks[good]
            if len(at) > 64:
                order = np.argsort(ranks, kind="stable")
                at, ranks = at[order], ranks[order]
                cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
                where = at.tolist()
                for r, a, b in zip(ranks[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(where)]):
                    queue.push(r, where[a:b])
            else:
                for r, p in zip(ranks.tolist(), at.tolist()):
                    queue.push(r, [p])

        push(np.flatnonzero(after >= 0))
        while (least := queue.pop()) is not None:
            rank, bucket = least
            at = np.array(bucket)
            at = at[rank_at[at] == rank]
            if not len(at):
                continue
            at.sort()
            chosen = at
            if len(at) > 1 and (linked := at[1:] == after[at[:-1]]).any():  # runs of one token: every second pair
                i = np.arange(len(at))
                first = np.maximum.accumulate(np.where(np.concatenate(([True], ~linked)), i, 0))
                chosen = at[(i - first) % 2 == 0]
            if self.lower[rank] and self._makes_lower(rank, tok, before, after, chosen):
                chosen = at[np.unique(piece[at], return_index=True)[1]]  # only the leftmost pair of each piece
                if len(rest := np.setdiff1d(at, chosen)):
                    queue.push(rank, rest.tolist())
            right = after[chosen]
            beyond = after[right]
            inner = beyond >= 0
            tok[chosen], tok[right], after[chosen] = rank, -1, beyond
            before[beyond[inner]] = chosen[inner]
            left = before[chosen]
            touched = np.unique(np.concatenate((chosen, left[left >= 0])))
            rank_at[right] = -1
            push(touched)
        alive = tok >= 0
        blob = tok[alive].astype("<u4").tobytes()
        cuts = np.concatenate(([0], np.cumsum(np.bincount(piece[alive], minlength=len(pieces))) * 4)).tolist()
        return [blob[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_batch(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        index: defaultdict[str, int] = defaultdict()
        index.default_factory = index.__len__
        find, number = self.pattern.findall, index.__getitem__
        docs = [np.array(list(map(number, find(t))), np.int32) for t in texts]
        parts: list[bytes | None] = [None] * len(index)
        fresh, pieces = [], []
        for i, text in enumerate(index):
            parts[i] = self.cache.get(text)
            if parts[i] is None:
                raw = text.encode()
                if (whole := self.ranks.get(raw)) is not None:
                    parts[i] = whole.to_bytes(4, "little")
                else:
                    fresh.append((i, text))
                    pieces.append(raw)
        if pieces:
            if len(self.cache) + len(pieces) > self.cached:
                self.cache.clear()
            room = self.cached
            for (i, text), ids in zip(fresh, self.merge(pieces)):
                parts[i] = ids
                if room > 0 and len(text) < 40:
                    self.cache[text] = ids
                    room -= 1
        return [b"".join(map(parts.__getitem__, d.tolist())) for d in docs]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[tuple[str, str], BPE] = {}


def loaded(path: str, pattern: str) -> BPE:
    """The encoding, loaded once a worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = BPE.load(path, pattern)
    return _LOADED[path, pattern]


def _vocabulary(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers as public

    return path or public.path("byte_bpe_multi_50k.tiktoken"), pattern or public.PATTERN


def _batches(frames: Iterator[pd.DataFrame], chars: int) -> Iterator[pd.DataFrame]:
    """The frames, gathered to about so many characters of text each."""
    held, size = [], 0
    for frame in frames:
        lengths = frame["text"].str.len().cumsum().to_numpy()
        while len(frame):
            k = int(np.searchsorted(lengths, chars - size)) + 1
            held.append(frame.iloc[:k])
            size += int(lengths[min(k, len(lengths)) - 1])
            if k > len(lengths):
                break
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
            lengths = lengths[k:] - lengths[k - 1]
            frame = frame.iloc[k:]
    if held:
        yield pd.concat(held, ignore_index=True)


def _mapped(docs: DataFrame, run, columns: str) -> DataFrame:
    """doc_id and what ``run`` makes of the texts; ids pass as text, as pandas would make numbers with nulls inexact."""
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(run, f"doc_id string, {columns}").withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, batch_chars: int = 20_000_000) -> DataFrame:
    """doc_id, ids (array<long>) of every row.  The vocabulary file must be at ``path`` on every executor."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(*_vocabulary(path, pattern))
        for frame in _batches(frames, batch_chars):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [np.frombuffer(b, "<u4").astype(np.int64) for b in bpe.encode_batch(frame["text"])]})

    return _mapped(docs, run, "ids array<long>")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` (ids array<long>) with ``decoded`` (binary)."""

    @F.pandas_udf("binary")
    def run(ids: pd.Series) -> pd.Series:
        bpe = loaded(*_vocabulary(path, pattern))
        return pd.Series([None if i is None else bpe.decode(i) for i in ids], dtype=object)

    return encoded.withColumn("decoded", run("ids"))


def query(docs: DataFrame, path: str | None = None, pattern: str | None = None, batch_chars: int = 20_000_000) -> DataFrame:
    """The rows of ``op8_bpe``: digests of the ids and of the bytes that they decode to."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(*_vocabulary(path, pattern))
        digest = lambda b: hashlib.sha256(b).hexdigest()
        for frame in _batches(frames, batch_chars):
            blobs = bpe.encode_batch(frame["text"])
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_tokens": [len(b) // 4 for b in blobs],
                    "ids_sha256": [digest(b) for b in blobs],
                    "decoded_sha256": [digest(bpe.decode(np.frombuffer(b, "<u4").tolist())) for b in blobs],
                }
            )

    return _mapped(docs, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
