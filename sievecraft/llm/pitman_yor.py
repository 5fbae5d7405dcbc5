"""Language-model scoring with a hierarchical Pitman-Yor model of word pairs.

Every context word has a restaurant whose dishes are the next words; all share the restaurant of single words as parent,
whose own base is uniform over the training words and one unknown word.  The seating of a dish is sampled by Gibbs: given
all other tables of its restaurant and the parent's probability of the dish, the number of its tables has the weights
S(c, t) * (theta + d*T)(theta + d*(T+1))... * P(w)^t, with generalised Stirling numbers S, which sums over all seatings of
the c customers at t tables.  Each table sends a customer to the parent, whose dishes are seated in the same way.

The levels take turns.  At first every dish has one table; the parent is swept, given these, until its tables settle;
then the children are swept, given the parent's probabilities, and after some sweeps several samples are kept; for each
of them the parent is swept anew.  A token's probability is the average of the samples' predictive probabilities.

Distribution.  Restaurants are dealt into shards by their context; those with very many customers are split by dish, so
no context fills a task.  In a sweep the tables of other dishes are those of the sweep before, and a part of a split
restaurant takes their total from its own; the probabilities use the totals over all parts.  A sweep of the parent takes
one number of a sample from the one before, the sum of all tables.  The texts are cut into chunks of about equal size; a
chunk asks only for its distinct words and pairs, in compressed arrays, so tokens themselves are never shuffled but with
their chunk, and a word or pair costs a chunk one entry however often it occurs.  Nothing that grows with the corpus is
collected or broadcast.  A chunk and a shard exchange one message, so both should grow with the corpus as far as a
task's memory allows (``chunk_tokens``, ``shard_chars``).

Results for special cases: a null or empty text is the end token alone; the remainder of a null id is that of the empty
text (0: held out); repeated rows are repeated training texts and each get their row; without training texts all words
are unknown and every token has probability 1; a text of any length stays in one chunk; an empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, saved, shards

_END = b""
_ROW = "kind int, chunk long, part int, blob binary"


@dataclass(frozen=True)
class Model:
    #: Fitted on training texts alone: those of remainder 1 scored by a model of remainders 2 to 9.
    discount: float = 0.75
    strength: float = 0.5
    parent_discount: float = 0.9
    parent_strength: float = 5.0
    burn_in: int = 2
    samples: int = 3
    #: The parent's sweeps end when no sample's tables change by more than this share, and after so many.
    parent_change: float = 0.005
    parent_sweeps: int = 50
    #: The base score's additive constant, and the remainder that is held out.
    add: float = 0.1
    folds: int = 10
    held_fold: int = 0
    chunk_tokens: int = 1_000_000
    shard_chars: int = 12_000_000
    #: Customers of a context for each of its parts.
    split_customers: int = 500_000
    #: Up to so many customers a dish's Stirling numbers come from their recurrence, beyond from their sum or saddle point.
    exact_customers: int = 2000


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


#: Names of arrays that never decrease; their differences are sent.
_RISING = ("u", "i")


def put(**arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays in their smallest type, byte by byte, compressed."""
    parts = {}
    for name, x in arrays.items():
        x = np.asarray(x)
        x = _small(np.diff(x, prepend=0) if name in _RISING else x)
        parts[name] = (x.dtype.str, np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, protocol=5))


def get(blob: bytes) -> dict[str, np.ndarray]:
    out = {}
    for name, (kind, raw) in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)).items():
        size = np.dtype(kind).itemsize
        x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel().astype(np.int64)
        out[name] = np.cumsum(x) if name in _RISING else x
    return out


def _frame(rows: list[tuple], columns: str = _ROW) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in columns.split(", ")])


# --- seating


class Stirling:
    """log S(c, t) of generalised Stirling numbers for one discount: S(c+1, t) = S(c, t-1) + (c - d*t) * S(c, t)."""

    TERMS = 160

    def __init__(self, discount: float, most: int) -> None:
        self.rows: list[np.ndarray] = [np.array([]), np.zeros(1)]
        self.discount, self.most = discount, most
        self.bands: dict[tuple[int, int], np.ndarray] = {}
        jd = [j * discount for j in range(1, self.TERMS + 1)]
        sines = [math.sin(math.pi * math.fmod(x, 2.0)) for x in jd]
        self.signs = np.array([(-1.0) ** (j + 1) * np.sign(s) if abs(s) > 1e-9 else 0.0 for j, s in enumerate(sines, 1)])
        self.fixed = np.array([math.lgamma(1 + x) + math.log(max(abs(s), 1e-300)) - math.lgamma(j + 1) - math.log(math.pi) for j, (x, s) in enumerate(zip(jd, sines), 1)])

    def row(self, c: int) -> np.ndarray:
        """For t from 1 to c, by the recurrence."""
        while len(self.rows) <= c:
            n, last = len(self.rows) - 1, self.rows[-1]
            stay = np.append(last + np.log(n - self.discount * np.arange(1, n + 1)), -np.inf)
            self.rows.append(np.logaddexp(np.append(-np.inf, last), stay))
        return self.rows[c]

    def band(self, low: int, high: int) -> np.ndarray:
        """The rows for c from ``low`` to ``high``, filled up with what no seating has."""
        if (low, high) not in self.bands:
            out = np.full((high - low + 1, high), -np.inf)
            for c in range(low, high + 1):
                out[c - low, :c] = self.row(c)
            self.bands[low, high] = out
        return self.bands[low, high]

    def at(self, c: int, t: np.ndarray) -> np.ndarray:
        """For any c, at some t: the finite sum S(c, t) = sum over j of (-1)^j C(t, j) (-jd)(-jd+1)...(-jd+c-1) / (d^t t!)
        where its terms do not cancel, else the saddle point of its generating function c! / t! ((1 - (1-x)^d) / d)^t."""
        d, t = self.discount, np.asarray(t, np.float64)
        out = np.empty(len(t))
        tame = t * c**-d <= (11 / (1 - d)) ** (1 - d)
        few, many = t[tame], t[~tame]
        factorials = np.array([math.lgamma(x + 1) for x in t.tolist()])
        if len(few):
            rising = np.array([math.lgamma(max(c - j * d, 0.5)) for j in range(1, self.TERMS + 1)])
            with np.errstate(divide="ignore"):
                falling = np.cumsum(np.log(np.maximum(few[:, None] - np.arange(self.TERMS), 0.0)), axis=1)
            logs = falling + self.fixed + rising
            logs[:, self.signs == 0] = -np.inf
            top = logs.max(1, keepdims=True)
            out[tame] = top[:, 0] + np.log(np.maximum((np.exp(logs - top) * self.signs).sum(1), 1e-300)) - few * math.log(d) - factorials[tame]
        if len(many):
            ratio = c / np.minimum(many, c - 0.5)
            low, high = np.full(len(many), -700.0), np.full(len(many), -1e-12)  # of log y, where y = 1 - x
            for _ in range(80):
                mid = (low + high) / 2
                y = np.exp(mid)
                over = d * (1 - y) * y ** (d - 1) / (1 - y**d) > ratio
                low, high = np.where(over, mid, low), np.where(over, high, mid)
            y = np.exp((low + high) / 2)
            x, h = -np.expm1((low + high) / 2), (1 - y**d) / d
            slope = x * y ** (d - 1) / h
            spread = many * (slope + x * x * (1 - d) * y ** (d - 2) / h - slope**2)
            out[~tame] = math.lgamma(c + 1) - factorials[~tame] + many * np.log(h) - c * np.log(x) - 0.5 * np.log(2 * math.pi * spread)
        out[t >= c] = 0.0
        return out


_TABLES: dict[tuple[float, int], Stirling] = {}


def _draw_many(c: int, others: float, p: float, stirling: Stirling, strength: float, rng: np.random.Generator) -> int:
    """The number of tables of one dish with very many customers: the same weights, at up to 256 places of the range that
    holds all but e^-30 of them."""
    d = stirling.discount
    first = strength / d + others

    def weights(t: np.ndarray) -> np.ndarray:
        return stirling.at(c, t) + t * math.log(d * p) + np.array([math.lgamma(first + x) for x in t.tolist()])

    low, high = 1, c
    t = np.unique(np.geomspace(low, high, 256).astype(np.int64))
    while True:
        w = weights(t)
        good = np.flatnonzero(w > w.max() - 30)
        a, z = int(t[max(0, good[0] - 1)]), int(t[min(len(t) - 1, good[-1] + 1)])
        dense = len(t) == high - low + 1
        if dense or (z - a) > 0.5 * (high - low):
            break
        low, high = a, z
        t = np.unique(np.linspace(low, high, min(256, high - low + 1)).astype(np.int64))
    gaps = np.diff(t, append=t[-1] + 1)
    found = int(np.argmax(w + np.log(gaps) + rng.gumbel(size=len(w))))
    return min(c, int(t[found]) + int(rng.integers(gaps[found])))


def draw_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, discount: float, strength: float, most: int, rng: np.random.Generator) -> np.ndarray:
    """The number of tables of dishes with c customers, given the tables of other dishes and the dishes' probabilities."""
    stirling = _TABLES.setdefault((discount, most), Stirling(discount, most))
    t = np.ones(len(c), np.int64)
    t[c == 0] = 0
    order = np.argsort(c, kind="stable")
    sorted_, low = c[order], 2
    while low <= most:  # customers of about the same number at a time
        high = min(most, low + low // 8)
        a, b = np.searchsorted(sorted_, [low, high + 1]).tolist()
        if a < b:
            rows, step, seats = stirling.band(low, high), max(1, 2_000_000 // high), np.arange(high)
            for i in range(a, b, step):
                at = order[i : min(b, i + step)]
                rise = np.cumsum(np.log(strength + discount * (others[at, None] + seats)), axis=1)
                weights = rows[c[at] - low] + rise + (seats + 1) * np.log(p[at, None])
                chance = np.cumsum(np.exp(weights - weights.max(1, keepdims=True)), axis=1)
                t[at] = 1 + (chance < rng.random((len(at), 1)) * chance[:, -1:]).sum(1)
        low = high + 1
    for i in order[np.searchsorted(sorted_, most, "right") :].tolist():
        t[i] = _draw_many(int(c[i]), float(others[i]), float(p[i]), stirling, strength, rng)
    return t


# --- chunks


def _bucket(words: list[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % n


def _chunks(frames: Iterator[pd.DataFrame], model: Model, n_buckets: int) -> Iterator[pd.DataFrame]:
    """Rows of kind 0 (a chunk's tokens) and 1 (its words of one bucket, with their counts in training texts)."""
    number = 0

    def close(ids: list, sizes: list[int], tokens: list[int], index: dict[bytes, int]) -> pd.DataFrame:
        nonlocal number
        chunk = TaskContext.get().partitionId() << 24 | number
        number += 1
        words = list(index)
        bucket = _bucket(words, n_buckets)
        order = np.argsort(bucket, kind="stable")  # local ids go by bucket, so that a bucket's words are a slice
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        tokens = place[np.array(tokens, np.int64)]
        held = np.array([zlib.crc32((i or "").encode()) % model.folds == model.held_fold for i in ids])
        counts = np.bincount(tokens[~np.repeat(held, sizes)], minlength=len(words))
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        ordered = [words[i] for i in order.tolist()]
        rows = [(0, chunk, 0, pickle.dumps((ids, put(sizes=sizes, held=held, tokens=tokens, end=np.array([place[index[_END]]])))))]
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            a, z = int(cuts[b]), int(cuts[b + 1])
            raw = zstandard.ZstdCompressor(level=1).compress(b"\n".join(ordered[a:z]))
            rows.append((1, chunk, b, pickle.dumps((raw, put(n=counts[a:z])))))
        return _frame(rows)

    def fresh() -> defaultdict:
        index = defaultdict()
        index.default_factory = index.__len__
        return index

    ids, sizes, tokens, index = [], [], [], fresh()
    for frame in frames:
        for doc, text in zip(frame["doc_id"], frame["text"]):
            words = text.encode().lower().split()
            tokens.extend(map(index.__getitem__, words))
            tokens.append(index[_END])
            ids.append(doc)
            sizes.append(len(words) + 1)
            if len(tokens) >= model.chunk_tokens:
                yield close(ids, sizes, tokens, index)
                ids, sizes, tokens, index = [], [], [], fresh()
    if ids:
        yield close(ids, sizes, tokens, index)


def _count_words(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: rows of kind 2, each chunk's words as counts and numbers in the bucket; and of kind 3, the totals."""
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    held = []
    for chunk, blob in zip(frame["chunk"], frame["blob"]):
        raw, n = pickle.loads(blob)
        words = zstandard.ZstdDecompressor().decompress(raw).split(b"\n")
        held.append((int(chunk), np.array(list(map(index.__getitem__, words)), np.int64), get(n)["n"]))
    counts = np.zeros(len(index), np.int64)
    for _, at, n in held:
        counts[at] += n
    part = int(frame["part"].iloc[0])
    rows = [(2, chunk, part, put(at=at, n=counts[at]), 0, 0) for chunk, at, _ in held]
    rows.append((3, -1, part, b"", int(counts.sum()), int((counts > 0).sum())))
    return _frame(rows, _ROW + ", n long, v long")


class Chunk:
    """A chunk's tokens with what is known of its words, and its distinct pairs in the order in which it asks for them."""

    def __init__(self, tokens: pd.DataFrame, words: pd.DataFrame, model: Model, n_shards: int) -> None:
        self.ids, blob = pickle.loads(tokens["blob"].iloc[0])
        x = get(blob)
        self.sizes, self.held, self.tokens, end = x["sizes"], x["held"].astype(bool), x["tokens"], int(x["end"][0])
        parts = sorted((int(p), get(b)) for p, b in zip(words["part"], words["blob"]))
        self.parts = [(p, len(y["at"])) for p, y in parts]
        gid = np.concatenate([y["at"] + (p << 32) for p, y in parts])
        #: Words are numbered anew in the order of their global numbers, so that pairs are sorted once.
        self.order = np.argsort(gid)
        rank = np.empty_like(self.order)
        rank[self.order] = np.arange(len(gid))
        gid, self.counts = gid[self.order], np.concatenate([y["n"] for _, y in parts])[self.order]
        self.tokens, end = rank[self.tokens], int(rank[end])
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = end
        self.before = before
        known = (self.counts[before] > 0) & (self.counts[self.tokens] > 0)
        n = len(self.counts)
        keys, inverse = np.unique(before[known] * n + self.tokens[known], return_inverse=True)
        left, right = keys // n, keys % n
        training = ~np.repeat(self.held, self.sizes)[known]
        pair_counts = np.bincount(inverse[training], minlength=len(keys))
        splits = 1 + self.counts[left] // model.split_customers
        mixed = gid[left].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed += (gid[right].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(40)) % splits.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(29)
        shard = (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % n_shards
        order = np.argsort(shard.astype(np.uint16) if n_shards <= 1 << 16 else shard, kind="stable")
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        #: The pair of each token, -1 if it or its context is unknown.
        self.pair = np.full(len(self.tokens), -1, np.int64)
        self.pair[known] = place[inverse]
        self.shard, self.left, self.right = shard[order], gid[left][order], gid[right][order]
        self.pair_counts, self.splits = pair_counts[order], splits[order]

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(np.repeat(np.arange(len(self.sizes)), self.sizes), weights=values, minlength=len(self.sizes))


def _ask_pairs(chunk: Chunk, number: int) -> pd.DataFrame:
    """Rows of kind 4: a chunk's pairs of one shard."""
    rows = []
    cuts = np.flatnonzero(np.diff(chunk.shard, prepend=-1)).tolist()
    for a, z in zip(cuts, [*cuts[1:], len(chunk.shard)]):
        s = slice(a, z)
        rows.append((4, number, int(chunk.shard[a]), put(u=chunk.left[s], w=chunk.right[s], n=chunk.pair_counts[s], s=chunk.splits[s])))
    return _frame(rows)


def _to_buckets(kind: int, shard: int, gid: np.ndarray, values: dict[str, np.ndarray]) -> list[tuple]:
    """Sums of the values by word, a row for each bucket of words."""
    order = np.argsort(gid, kind="stable")
    ids, where = np.unique(gid[order], return_inverse=True)
    sums = {k: np.bincount(where, weights=v[order], minlength=len(ids)).astype(np.int64) for k, v in values.items()}
    parts = ids >> 32
    cuts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
    return [(kind, shard, int(parts[a]), put(at=ids[a:z] & 0xFFFFFFFF, **{k: v[a:z] for k, v in sums.items()})) for a, z in zip(cuts, [*cuts[1:], len(ids)])]


def _open_shard(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one shard: merges the chunks' pairs.

    A row of kind 9, the shard with one table for each dish, and which of its dishes each chunk asked for; rows of kind 7:
    to a bucket of words, the words' tables.
    """
    shard = int(frame["part"].iloc[0])
    held = sorted((int(c), get(b)) for c, b in zip(frame["chunk"], frame["blob"]))
    field = lambda name: np.concatenate([x[name] for _, x in held])
    u, w, n, s = (field(name) for name in "uwns")
    order = np.lexsort((w, u))
    u, w = u[order], w[order]
    new = np.concatenate(([True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])))
    inverse = np.empty(len(u), np.int64)
    inverse[order] = np.cumsum(new) - 1
    c = np.bincount(inverse, weights=n).astype(np.int64)
    ends = np.cumsum([len(x["u"]) for _, x in held])
    maps = [(chunk, put(i=x)) for (chunk, _), x in zip(held, np.split(inverse, ends[:-1]))]
    blob = pickle.dumps((put(u=u[new], w=w[new], c=c, s=s[order][new]), maps))
    return _frame([(9, shard, shard, blob), *_to_buckets(7, shard, w[new], {"t0": (c > 0).astype(np.int64)})])


def _seat(frame: pd.DataFrame, model: Model) -> pd.DataFrame:
    """Of one shard, given the parent's probabilities of its words (kind 11): samples the seating, and answers.

    Rows of kind 5: to a chunk, its pairs' customers and tables in each sample; of kind 6 and 7: to a bucket of words,
    the contexts' customers and tables, and the words' tables.
    """
    shard = int(frame["part"].iloc[0])
    raw, maps = pickle.loads(frame.loc[frame["kind"] == 9, "blob"].iloc[0])
    x = get(raw)
    u, w, c, split = x["u"], x["w"], x["c"], x["s"].astype(np.float64)
    told = frame[frame["kind"] == 11]
    told = [(int(k) << 32, get(b)) for k, b in zip(told["chunk"], told["blob"])]  # sent by bucket
    gid, level = (np.concatenate([y[name] + base * (name == "at") for base, y in told]) for name in ("at", "p"))
    order = np.argsort(gid)
    p = np.exp2(-level[order][np.searchsorted(gid, w, sorter=order)] / _LEVELS)
    context = np.cumsum(np.concatenate(([0], (u[1:] != u[:-1]).astype(np.int64))))
    rng = np.random.default_rng([shard, 20])
    several = np.flatnonzero(c > 1)
    t = (c > 0).astype(np.int64)
    samples = []
    for sweep in range(model.burn_in + model.samples):
        if len(several):
            tables = np.bincount(context, weights=t)
            others = np.maximum(0.0, tables[context[several]] * split[several] - t[several])
            t = t.copy()
            t[several] = draw_tables(c[several], others, p[several], model.discount, model.strength, model.exact_customers, rng)
        if sweep >= model.burn_in:
            samples.append(t)
    tables = {f"t{k}": t for k, t in enumerate(samples)}
    rows = []
    for chunk, blob in maps:
        mine = get(blob)["i"]
        rows.append((5, chunk, shard, put(c=c[mine], **{k: t[mine] for k, t in tables.items()})))
    return _frame([*rows, *_to_buckets(6, shard, u, {"c": c} | tables), *_to_buckets(7, shard, w, tables)])


_PARENT = _ROW + ", customers array<long>, tables array<long>"


def _merge_words(frame: pd.DataFrame, samples: int) -> pd.DataFrame:
    """Of one bucket of words: a row of kind 10, its contexts, parent customers and tables, with one table for each word."""
    part = int(frame["part"].iloc[0])
    rows = [(int(k), get(b)) for k, b in zip(frame["kind"], frame["blob"])]
    size = 1 + max(int(x["at"].max()) for _, x in rows)
    names = [f"t{k}" for k in range(samples)]
    contexts = {k: np.zeros(size, np.int64) for k in ["c", *names]}
    customers = {k: np.zeros(size, np.int64) for k in names}
    for kind, x in rows:
        if kind in (6, 7):
            for k, v in (contexts if kind == 6 else customers).items():
                v[x["at"]] += x[k]
    tables = [np.minimum(customers[k], 1) for k in names]
    words = {"c": contexts["c"], **{f"u{k}": contexts[k] for k in names}, **{f"w{k}": customers[k] for k in names}}
    blob = pickle.dumps((put(**words), put(**{f"s{k}": t for k, t in zip(names, tables)})))
    return _frame([(10, -1, part, blob, [int(customers[k].sum()) for k in names], [int(t.sum()) for t in tables])], _PARENT)


def _sweep_parent(frames: Iterator[pd.DataFrame], model: Model, types: int, totals: list[int], sweep: int) -> Iterator[pd.DataFrame]:
    """Rows of kind 10 after a sweep, given the tables of all buckets after the one before."""
    for frame in frames:
        rows = []
        for part, blob, customers in zip(frame["part"], frame["blob"], frame["customers"]):
            raw, seated = pickle.loads(blob)
            words, seated = get(raw), get(seated)
            rng = np.random.default_rng([int(part), 21, sweep])
            for k, total in enumerate(totals):
                c, t = words[f"wt{k}"], seated[f"st{k}"]
                p = np.full(len(c), 1.0 / (types + 1))
                seated[f"st{k}"] = draw_tables(c, np.maximum(0.0, total - t), p, model.parent_discount, model.parent_strength, model.exact_customers, rng)
            rows.append((10, -1, int(part), pickle.dumps((raw, put(**seated))), list(customers), [int(seated[f"st{k}"].sum()) for k in range(len(totals))]))
        yield _frame(rows, _PARENT)


def _parent_totals(parent: DataFrame, samples: int) -> tuple[list[int], list[int]]:
    each = parent.agg(*(F.sum(F.get(c, F.lit(k))) for c in ("customers", "tables") for k in range(samples))).first()
    sums = [int(x or 0) for x in each]
    return sums[:samples], sums[samples:]


def _seat_parent(rows: DataFrame, model: Model, types: int, samples: int) -> tuple[DataFrame, list[int], list[int]]:
    """The parent's seating (kind 10) after sweeps over all words until its tables settle; its customers and tables."""
    parent = saved(rows.groupBy("part").applyInPandas(lambda x: _merge_words(x, samples), _PARENT))
    customers, tables = _parent_totals(parent, samples)
    for sweep in range(model.parent_sweeps):
        before = tables
        step = lambda frames, s=sweep, t=before: _sweep_parent(frames, model, types, t, s)
        parent = saved(parent.mapInPandas(step, _PARENT))
        _, tables = _parent_totals(parent, samples)
        if sweep >= model.burn_in and all(abs(t - b) <= model.parent_change * b for t, b in zip(tables, before)):
            break
    return parent, customers, tables


#: Steps of an octave in which probabilities are told to the shards, which only draw by them.
_LEVELS = 1024


def _tell_shards(frame: pd.DataFrame, model: Model, types: int, customers: int, tables: int) -> pd.DataFrame:
    """Of one bucket of words: the parent's probabilities (kind 11, with the bucket as chunk) to the shards that named
    them (kind 7)."""
    raw, seated = pickle.loads(frame.loc[frame["kind"] == 10, "blob"].iloc[0])
    n, t = get(raw)["wt0"], get(seated)["st0"]
    p = (n - model.parent_discount * t + (model.parent_strength + model.parent_discount * tables) / (types + 1)) / (model.parent_strength + customers)
    level = np.round(-np.log2(p) * _LEVELS).astype(np.int64)
    named = frame[frame["kind"] == 7]
    rows = []
    for shard, part, blob in zip(named["chunk"], named["part"], named["blob"]):
        at = get(blob)["at"]
        rows.append((11, int(part), int(shard), put(at=at, p=level[at])))
    return _frame(rows)


def _answer_words(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket of words: the answers (kind 8) to the chunks that asked (kind 2)."""
    raw, seated = pickle.loads(frame.loc[frame["kind"] == 10, "blob"].iloc[0])
    words = get(raw) | get(seated)
    asked = frame[frame["kind"] == 2]
    rows = []
    for chunk, part, blob in zip(asked["chunk"], asked["part"], asked["blob"]):
        at = get(blob)["at"]
        rows.append((8, int(chunk), int(part), put(**{k: v[at] for k, v in words.items()})))
    return _frame(rows)


def _score(chunk: Chunk, pairs: pd.DataFrame, words: pd.DataFrame, model: Model, total: int, types: int, customers: list[int], tables: list[int], each: bool = False) -> pd.DataFrame:
    tokens, before = chunk.tokens, chunk.before
    answers = [get(b) for _, b in sorted(zip(pairs["part"], pairs["blob"]), key=lambda x: x[0])]
    about = [get(b) for _, b in sorted(zip(words["part"], words["blob"]), key=lambda x: x[0])]
    word = {k: np.concatenate([x[k] for x in about])[chunk.order] for k in about[0]}
    pair = {k: np.append(np.concatenate([x[k] for x in answers]), 0) for k in answers[0]} if answers else {k: np.zeros(1, np.int64) for k in ["c", *(f"t{k}" for k in range(model.samples))]}
    chance = np.zeros(len(tokens))
    d, strength, pd_, ps = model.discount, model.strength, model.parent_discount, model.parent_strength
    for k in range(model.samples):
        c0, t0 = customers[k], tables[k]
        parent = (word[f"wt{k}"] - pd_ * word[f"st{k}"] + (ps + pd_ * t0) / (types + 1)) / (ps + c0)
        seen = pair["c"][chunk.pair] - d * pair[f"t{k}"][chunk.pair]
        chance += (seen + (strength + d * word[f"ut{k}"][before]) * parent[tokens]) / (strength + word["c"][before])
    chance /= model.samples
    counts = chunk.counts[tokens]
    base = np.log10((counts + model.add) / (total + model.add * (types + 1)))
    out = {
        "doc_id": chunk.ids, "held_out": chunk.held, "n_tokens": chunk.sizes, "n_known": chunk.per_document(counts > 0).astype(np.int64), "train_tokens": total,
        "base_score": chunk.per_document(base), "score": chunk.per_document(np.log10(chance)),
    }
    return pd.DataFrame(out | {"chances": np.split(chance, np.cumsum(chunk.sizes)[:-1])} if each else out)


def score(docs: DataFrame, model: Model = Model(), each: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; with ``each``, also the chances of
    its tokens."""
    # ids pass as text, as pandas would make numbers with nulls inexact
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    parts = shards(docs, F.length("text") + 1, model.shard_chars)
    rows = saved(texts.mapInPandas(lambda frames: _chunks(frames, model, parts), _ROW))
    chunks = rows.filter("kind = 0")
    words = saved(rows.filter("kind = 1").groupBy("part").applyInPandas(_count_words, _ROW + ", n long, v long"))
    sums = words.filter("kind = 3").agg(F.sum("n"), F.sum("v")).first()
    total, types = int(sums[0] or 0), int(sums[1] or 0)
    words = words.filter("kind = 2").select("kind", "chunk", "part", "blob")

    scratch = Scratch(docs.sparkSession)
    asked = chunks.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInPandas(lambda a, b: _ask_pairs(Chunk(a, b, model, parts), int(a["chunk"].iloc[0])), _ROW)
    opened = scratch.keep(asked.groupBy("part").applyInPandas(_open_shard, _ROW))
    named = opened.filter("kind = 7")
    first, customers, tables = _seat_parent(words.union(named), model, types, 1)
    by_word = named.union(first.select("kind", "chunk", "part", "blob")).groupBy("part")
    told = scratch.keep(by_word.applyInPandas(lambda x: _tell_shards(x, model, types, customers[0], tables[0]), _ROW))
    seated = saved(opened.filter("kind = 9").union(told).groupBy("part").applyInPandas(lambda x: _seat(x, model), _ROW))
    scratch.drop()
    parent, customers, tables = _seat_parent(words.union(seated.filter("kind in (6, 7)")), model, types, model.samples)
    told = saved(words.union(parent.select("kind", "chunk", "part", "blob")).groupBy("part").applyInPandas(_answer_words, _ROW))

    answers = words.union(seated.filter("kind = 5")).union(told)

    def finish(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        of = lambda k: b[b["kind"] == k]
        return _score(Chunk(a, of(2), model, parts), of(5), of(8), model, total, types, customers, tables, each)

    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(finish, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double" + ", chances array<double>" * each)
    return scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, n_tokens, perplexity and base_perplexity of scored documents."""
    of = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), of("score").alias("perplexity"), of("base_score").alias("base_perplexity"))


def query(docs: DataFrame) -> DataFrame:
    """The rows of ``op2_pitman_yor``."""
    return score(docs)
