import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sievecraft.llm import pitman_yor as py


def test_query_base(docs, clashing, rows):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    texts = [(d, [*(t or "").encode().lower().split(), b""]) for d, t in rows]
    count = Counter(w for d, t in texts if not held(d) for w in t)
    n, v = sum(count.values()), len(count)
    expected = Counter((d, held(d), len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for d, t in texts)
    model = py.Model(chunk_tokens=700, shard_chars=20_000)
    for frame, m in ((docs, model), (docs, py.Model()), (clashing, model)):
        got = py.score(frame, m).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_held_out_perplexity_beats_the_base(docs):
    scored = py.score(docs, py.Model(chunk_tokens=900, shard_chars=20_000)).cache()
    for r in py.perplexity(scored).collect():
        assert r.perplexity < r.base_perplexity


def test_repeatable(docs):
    model = py.Model(chunk_tokens=900, shard_chars=20_000)
    a, b = ({(r.doc_id, r.score) for r in py.score(docs, model).collect()} for _ in range(2))
    assert a == b


def test_empty_and_untrained(spark, empty):
    assert py.query(empty).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = py.query(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score == pytest.approx(0) and row.base_score == pytest.approx(0)


def test_stirling_rows_and_draws():
    """Against sums over all seatings of few customers."""
    d, strength, p, others = 0.6, 1.5, 0.2, 3
    s = py.Stirling(d, 100)
    weights = {1: {(1,): 1.0}}
    for c in range(2, 7):  # every seating as the sorted sizes of its tables
        weights[c] = {}
        for sizes, w in weights[c - 1].items():
            for k in range(len(sizes)):
                grown = tuple(sorted((*sizes[:k], sizes[k] + 1, *sizes[k + 1 :])))
                weights[c][grown] = weights[c].get(grown, 0) + w * (sizes[k] - d)
            new = tuple(sorted((*sizes, 1)))
            weights[c][new] = weights[c].get(new, 0) + w
        for t in range(1, c + 1):
            assert math.exp(s.row(c)[t - 1]) == pytest.approx(sum(w for sizes, w in weights[c].items() if len(sizes) == t))
    c, n = 6, 40_000
    exact = np.array([sum(w for z, w in weights[c].items() if len(z) == t) * math.prod(strength + d * (others + j) for j in range(t)) * p**t for t in range(1, c + 1)])
    drawn = py.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, strength, 100, np.random.default_rng(1))
    assert np.abs(np.bincount(drawn, minlength=c + 1)[1:] / n - exact / exact.sum()).max() < 0.01


def test_large_stirling_numbers():
    """The sum and the saddle point against the recurrence, up to a hundredth."""
    for d in (0.3, 0.7, 0.75, 0.9):
        s = py.Stirling(d, 10)
        for c in (300, 1200):
            exact = s.row(c)
            t = np.unique(np.geomspace(1, c - 20, 60).astype(int))
            assert np.abs(s.at(c, t) - exact[t - 1]).max() < 0.01
            assert np.abs(np.diff(s.at(c, np.arange(20, c // 2))) - np.diff(exact[19 : c // 2 - 1])).max() < 0.01


@pytest.mark.parametrize("others, p", [(5, 0.001), (300, 0.01), (20_000, 0.2)])
def test_draws_of_many_customers(others, p):
    """Against draws from the recurrence's weights."""
    d, strength, c, n = 0.75, 0.5, 1500, 3000
    near = py.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, strength, 2000, np.random.default_rng(1))
    far = py.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, strength, 1000, np.random.default_rng(2))
    assert far.mean() == pytest.approx(near.mean(), rel=0.02, abs=0.1) and far.std() == pytest.approx(near.std(), rel=0.08, abs=0.1)
    assert far.min() >= 1 and far.max() <= c


TINY = ["a b a c", "a b", "c a a b b", "b c c c a", "a b a b", ""] * 6


def _tiny(spark, extra):
    train = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(300, 1500) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = list(zip(train, TINY)) + list(zip(held, extra))
    return dict(zip(held, extra)), spark.createDataFrame(rows, "doc_id long, text string")


def test_probabilities_sum_to_one(spark):
    """Over every training word, the end and the unknown word, after every known context and an unknown one."""
    words = ["a", "b", "c", "zzz"]
    texts, frame = _tiny(spark, [f"{u} {w}".strip() for u in words for w in (*words, "")] + words + [""])
    for model in (py.Model(), py.Model(samples=1, burn_in=1), py.Model(split_customers=5, shard_chars=50)):
        chance = {}
        for r in py.score(frame, model, each=True).collect():
            if r.doc_id in texts:
                assert r.score == pytest.approx(sum(map(math.log10, r.chances)))
                before = ""
                for w, p in zip([*texts[r.doc_id].split(), ""], r.chances):
                    assert chance.setdefault((before, w), p) == pytest.approx(p)
                    before = w
        for u in ("", *words):
            assert sum(chance[u, w] for w in ("", *words)) == pytest.approx(1, abs=1e-9), u


def plain_sampler(texts, model, sweeps, seed):
    """The model by seating one customer at a time, in both levels; the mean predictive probabilities."""
    rnd = np.random.default_rng(seed)
    pairs = [(u, w) for t in texts for u, w in zip(["", *t.split()], [*t.split(), ""])]
    words = sorted({w for _, w in pairs})
    child, parent = {}, {}  # (u, w) and w: sizes of the tables

    def base(w):
        total, tables = sum(map(sum, parent.values())), sum(map(len, parent.values()))
        own = parent.get(w, [])
        return (sum(own) - model.parent_discount * len(own) + (model.parent_strength + model.parent_discount * tables) / (len(words) + 1)) / (model.parent_strength + total)

    def sit(tables, discount, new):
        weights = np.array([n - discount for n in tables] + [new])
        k = rnd.choice(len(weights), p=weights / weights.sum())
        if k == len(tables):
            tables.append(1)
            return True
        tables[k] += 1
        return False

    def leave(tables):
        k = rnd.choice(len(tables), p=np.array(tables) / sum(tables))
        tables[k] -= 1
        if not tables[k]:
            tables.pop(k)
            return True
        return False

    def tables_of(u):
        return sum(len(t) for (v, _), t in child.items() if v == u)

    def add(u, w):
        new = (model.strength + model.discount * tables_of(u)) * base(w)
        if sit(child.setdefault((u, w), []), model.discount, new):
            every = sum(map(len, parent.values()))
            sit(parent.setdefault(w, []), model.parent_discount, (model.parent_strength + model.parent_discount * every) / (len(words) + 1))

    for u, w in pairs:
        add(u, w)
    mean, kept = Counter(), 0
    for sweep in range(sweeps):
        for u, w in pairs:
            if leave(child[u, w]):
                leave(parent[w])
            add(u, w)
        if sweep >= sweeps // 3:
            kept += 1
            for u in words:
                n, t = sum(sum(x) for (v, _), x in child.items() if v == u), tables_of(u)
                for w in words:
                    own = child.get((u, w), [])
                    mean[u, w] += (sum(own) - model.discount * len(own) + (model.strength + model.discount * t) * base(w)) / (model.strength + n)
    return {k: v / kept for k, v in mean.items()}


def test_against_a_plain_sampler(spark):
    words = ["a", "b", "c"]
    texts, frame = _tiny(spark, [f"{u} {w}".strip() for u in words for w in (*words, "")] + words)
    model = py.Model(samples=40, burn_in=10)
    expected = plain_sampler([r.text for r in frame.collect() if zlib.crc32(str(r.doc_id).encode()) % 10], model, 60, 3)
    seen = 0
    for r in py.score(frame, model, each=True).collect():
        if r.doc_id in texts:
            w = ["", *texts[r.doc_id].split(), ""]
            for u, v, p in zip(w, w[1:], r.chances):
                assert p == pytest.approx(expected[u, v], abs=0.03), (u, v)
                seen += 1
    assert seen > 20


def test_packing_of_arrays():
    for x in ([], [0], [1, 255, 256, 70_000, 1 << 40], list(range(1000))):
        assert py.get(py.put(a=np.array(x, np.int64), b=np.array([3])))["a"].tolist() == x


def test_the_parent_settles(spark):
    """Its tables against the fixed point of their expectation, over words with many customers."""
    model, size = py.Model(), 3000
    n = np.maximum(1, 3000 // np.arange(1, size + 1))
    blob = py.put(at=np.arange(size), **{f"t{k}": n for k in range(model.samples)})
    asked = spark.createDataFrame([(2, 5, 0, py.put(at=np.arange(size), n=n)), (7, 0, 0, blob)], py._ROW)
    _, customers, tables = py._seat_parent(asked, model, size, model.samples)
    total, once, rng = float(size), None, np.random.default_rng(7)
    for _ in range(60):
        drawn = py.draw_tables(n, np.full(size, total - 1), np.full(size, 1 / (size + 1)), model.parent_discount, model.parent_strength, model.exact_customers, rng)
        total = float(drawn.sum())
        once = once or total
    assert customers == [int(n.sum())] * model.samples
    assert all(t == pytest.approx(total, rel=0.03) and t > 1.1 * once for t in tables)
