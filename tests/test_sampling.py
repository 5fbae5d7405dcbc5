"""Allocation and sampling."""

import random

import pandas as pd

from sievecraft.config import Bucket, Query, Sampling
from sievecraft.operators import sampling

HALVES = (Bucket("high", 1000, None, 0.5), Bucket("low", 100, 999, 0.5))


def greedy(weights, available, total, renormalize):
    """One slot at a time to the largest unmet share."""
    out = {n: 0 for n, _ in weights}
    live = [(n, w) for n, w in weights if w > 0 and available.get(n, 0) > 0]
    if total <= 0 or not live:
        return out
    scale = sum(w for _, w in live)
    share = {n: total * w / scale if renormalize else total * w for n, w in live}
    for n in share:
        out[n] = min(available[n], int(share[n]))
    while sum(out.values()) < total:
        open_ = [n for n in share if out[n] < available[n]]
        if not open_:
            break
        out[max(open_, key=lambda n: (share[n] - out[n], available[n] - out[n]))] += 1
    return out


def cases(n, seed=4):
    rnd = random.Random(seed)
    for _ in range(n):
        k = rnd.randrange(1, 6)
        weights = [(f"g{i}", rnd.choice([0.0, 0.1, 0.25, 0.25, 0.5, rnd.random()])) for i in range(k)]
        yield weights, {f"g{i}": rnd.choice([0, 1, 3, rnd.randrange(30)]) for i in range(k)}, rnd.choice([0, 1, 5, rnd.randrange(60)]), rnd.random() < 0.5


def test_allocate_is_the_greedy_rule():
    for weights, available, total, renormalize in cases(4000):
        assert sampling.allocate(weights, available, total, renormalize) == greedy(weights, available, total, renormalize)


def test_allocation_as_a_plan(spark):
    for weights, available, total, renormalize in cases(12, 9):
        groups = spark.createDataFrame([(n, w, i, available[n]) for i, (n, w) in enumerate(weights)], "name string, weight double, place long, available long")
        got = {r.name: r.allocated for r in sampling.allocation(groups, total, renormalize).collect()}
        assert got == greedy(weights, available, total, renormalize), (weights, available, total, renormalize)


def pool(spark, rows):
    return spark.createDataFrame(rows, "full_name string, stars long, query_names array<string>")


def test_stratified_run(spark):
    """Six unseen repositories of two queries and two star bands; four are taken."""
    rows = [(f"o/r{i}", s, ["q1" if i % 2 else "q2"]) for i, s in enumerate((4000, 3000, 900, 800, 700, 600))]
    queries = [Query("q1", "x", 0.5), Query("q2", "y", 0.5)]
    got = sampling.select_repositories(pool(spark, rows), queries, Sampling("stratified", 4, 100, 42, True, HALVES)).collect()
    assert len(got) == 4 and len({r.full_name for r in got}) == 4 and sorted(r.place for r in got) == [0, 1, 2, 3]
    assert sum(r.query_names == ["q1"] for r in got) == 2


def test_top_keeps_query_quotas(spark):
    """The quotas hold for every strategy: the least of q2 comes before the second of q1."""
    rows = [("a", 900, ["q1"]), ("b", 800, ["q1"]), ("c", 10, ["q2"]), ("d", 5, ["q2"])]
    got = sampling.select_repositories(pool(spark, rows), [Query("q1", "", 0.5), Query("q2", "", 0.5)], Sampling("top", 2, 0, 1, True, HALVES))
    assert {r.full_name for r in got.collect()} == {"a", "c"}


def test_fill_draws_from_all_that_is_unseen(spark):
    """The pool is cut to three, yet eight of ten are selected."""
    rows = [(f"n{i}", i * 300, ["q1"]) for i in range(10)]
    for strategy in ("top", "random", "stratified"):
        got = sampling.select_repositories(pool(spark, rows), [Query("q1", "", 1.0)], Sampling(strategy, 8, 3, 1, True, HALVES)).collect()
        assert len({r.full_name for r in got}) == 8, strategy


def test_several_memberships_count_once_selected():
    frame = pd.DataFrame({"full_name": ["a", "b", "c"], "stars": [5, 4, 3], "query_names": [["q1", "q2"], ["q1", "q2"], ["q2"]]})
    names = sampling.plan(frame, 3, [Query("q1", "", 1.0), Query("q2", "", 1.0)], Sampling("top", 3, 0, 1, True, HALVES))
    assert len(names) == len(set(names)) and set(names) <= {"a", "b", "c"}


def test_samples_do_not_depend_on_partitions(spark):
    rows = [(f"n{i}", i * 7 % 2500, ["q"]) for i in range(200)]
    cfg = Sampling("stratified", 50, 0, 42, True, HALVES)
    one = {r.full_name for r in sampling.sample(pool(spark, rows).coalesce(1), 50, cfg).collect()}
    many = {r.full_name for r in sampling.sample(pool(spark, rows[::-1]).repartition(7), 50, cfg).collect()}
    assert one == many and len(one) == 50


def test_multi_membership_uses_every_hit(spark, tmp_path, monkeypatch):
    from sievecraft import queries

    spark.sql("select id as l_partkey, id + k * 1000 as l_suppkey, timestamp '2020-01-01' as l_shipdate from range(20) lateral view explode(array(1, 2)) as k").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select id as p_partkey, 'part' as p_name, 900.0 + id as p_retailprice from range(20)").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(queries.sampling, "select_repositories", lambda pool, *_: pool)
    got = {r.full_name: r.query_names for r in queries.multi_membership(spark, str(tmp_path)).collect()}
    assert got == {f"part/{i}": sorted({f"q{1 + (i + k * 1000) % 8}" for k in (1, 2)}) for i in range(20)}
