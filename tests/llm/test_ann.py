import math
from collections import defaultdict

import numpy as np
import pytest

from sievecraft.llm import ann

INF, NAN = math.inf, math.nan


def brute(rows, k=10, every=100):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for i, q in good:
        if i % every == 0:
            near = {(float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in good if j != i and len(v) == len(q)}
            out[i] = sorted(near)[:k]
    return out


def hits(found):
    out = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 24))
    rows = [(i, (centers[i % 12] + 0.4 * rng.normal(size=24)).astype(np.float32).tolist()) for i in range(3000)]
    rows += [(5000 + i, rows[100][1]) for i in range(300)]  # many copies of one vector
    return rows + [(9000, None), (9100, [0.0] * 24), (9200, [NAN] + [1.0] * 23), (9300, [INF] + [1.0] * 23), (9400, [None] + [1.0] * 23), (9500, [1.0, 2.0]), (9600, [1.0, 2.5]), (None, rows[0][1]), (5000, rows[100][1])]


def test_recall_and_order(spark, vectors):
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    expected, got = brute(vectors), hits(ann.search(frame, shard_size=400))
    assert set(got) == set(expected) and all(len(got[q]) == len(expected[q]) for q in expected)
    assert all(v == sorted(v) for v in got.values())
    same = sum(len({i for _, i in got[q]} & {i for _, i in expected[q]}) for q in expected)
    assert same >= 0.97 * sum(map(len, expected.values()))
    assert [i for _, i in got[5000]] == [100, *range(5001, 5010)]  # ties go to the smaller id
    exact = {(q, i): s for q in expected for s, i in expected[q]}
    assert all(s == pytest.approx(exact[q, i], abs=1e-12) for q in got for s, i in got[q] if (q, i) in exact)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>, shard string, ids long, v int"
    few = spark.createDataFrame([(0, [1.0, 0.0], "x", 1, 1), (1, [2.0, 0.0], None, None, None)], schema)
    assert [tuple(r) for r in ann.query(few).collect()] == [(0, 1, 1, 1.0)]
    assert ann.query(spark.createDataFrame([], schema)).count() == 0
    assert ann.query(spark.createDataFrame([(100, [1.0], "", 1, 1)], schema)).count() == 0


def test_flat_arrays_hold_the_graph():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    graph = ann.HNSW(x)
    again = ann.HNSW.of_flat(x, graph.flat())
    for q in rng.normal(size=(20, 8)):
        assert graph.search(q, 5, 40) == again.search(q, 5, 40)


@pytest.mark.parametrize("shift, scale, noise", [(1000, 1, 1.0), (0, 1e19, 1.0), (0, 1e-19, 1.0), (1e6, 1e3, 1.0), (0, 1, 0.02)])
def test_recall_wherever_the_vectors_lie(spark, shift, scale, noise):
    """Far from the origin, very large, very small, and in narrow clusters."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(30, 16))
    x = ((centers[np.arange(1500) % 30] + noise * rng.normal(size=(1500, 16)) + shift) * scale).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    expected, got = brute(rows), hits(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard_size=500))
    same = sum(len({i for _, i in got[q]} & {i for _, i in expected[q]}) for q in expected)
    assert same >= 0.95 * sum(map(len, expected.values()))


def test_each_graph_is_read_by_one_task_with_all_blocks(spark, vectors):
    """Blocks of any size give the same."""
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    few, many = (sorted(map(tuple, ann.search(frame, shard_size=700, block=n).collect())) for n in (1, 1000))
    assert few == many
