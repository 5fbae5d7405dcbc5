"""Allocation of a total over groups, and samples of repositories by strategy.

Picks are ordered by a seeded hash of stage and name: the same for every partitioning and every run.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Query, Sampling
from ..functions.records import seeded_rank
from .repositories import star_bucket


def allocate(weights: Sequence[tuple[str, float]], available: Mapping[str, int], total: int, renormalize: bool = False) -> dict[str, int]:
    """How many each group gets: its rounded-down share, then single slots by the largest unmet share, availability
    breaking ties, then the groups' order; never more than there are."""
    out = dict.fromkeys((name for name, _ in weights), 0)
    live = [(name, w) for name, w in weights if w > 0 and available.get(name, 0) > 0]
    scale = sum(w for _, w in live) if renormalize else 1.0
    if total <= 0 or not live:
        return out
    share = {name: total * w / scale if renormalize else total * w for name, w in live}
    for name, _ in live:
        out[name] = min(available[name], int(share[name]))
    slots = []
    for place, (name, _) in enumerate(live):
        if out[name] < available[name]:
            heapq.heappush(slots, (out[name] - share[name], out[name] - available[name], place, name))
    for _ in range(total - sum(out.values())):
        if not slots:
            break
        _, _, place, name = heapq.heappop(slots)
        out[name] += 1
        if out[name] < available[name]:
            heapq.heappush(slots, (out[name] - share[name], out[name] - available[name], place, name))
    return out


def allocation(groups: DataFrame, total: int, renormalize: bool = False) -> DataFrame:
    """``allocate`` as a plan.  groups: name, weight, place (the order), available.  name, allocated of every group."""
    live = groups.filter("weight > 0 and available > 0")
    scale = float(live.agg(F.sum("weight")).first()[0] or 1.0) if renormalize else 1.0  # a number, like the one below
    share = F.lit(float(total)) * F.col("weight")
    base = live.withColumn("share", share / F.lit(scale) if renormalize else share)
    base = base.withColumn("base", F.least("available", F.floor("share")).cast("long"))
    left = max(0, total - int(base.agg(F.sum("base")).first()[0] or 0))
    # no group can win more slots than are left
    slots = base.filter("base < available").withColumn("k", F.explode(F.sequence("base", F.least(F.col("available"), F.col("base") + max(1, left)) - 1)))
    nth = F.row_number().over(Window.orderBy((F.col("share") - F.col("k")).desc(), (F.col("available") - F.col("k")).desc(), "place", "k"))
    won = slots.withColumn("nth", nth).filter(F.col("nth") <= left).groupBy(F.col("name").alias("w")).agg(F.count("*").alias("won"))
    got = base.select(F.col("name").alias("g"), "base").join(won, F.col("g") == F.col("w"), "left")
    return groups.join(got, F.col("name") == F.col("g"), "left").select("name", (F.coalesce("base", F.lit(0)) + F.coalesce("won", F.lit(0))).cast("long").alias("allocated"))


def top(pool: DataFrame, n: int) -> DataFrame:
    """Most stars first, then by name."""
    return pool.orderBy(F.col("stars").desc(), "full_name").limit(n)


def random(pool: DataFrame, n: int, seed: int, stage: str = "random") -> DataFrame:
    return pool.orderBy(seeded_rank(F.col("full_name"), seed, stage), "full_name").limit(n)


def stratified(pool: DataFrame, n: int, cfg: Sampling, stage: str = "stratified") -> DataFrame:
    """Allocated over the star buckets; what they cannot fill comes from all that is left."""
    buckets = cfg.star_buckets
    ranked = pool.withColumns({"bucket": star_bucket(F.col("stars"), buckets), "rank_": seeded_rank(F.col("full_name"), cfg.seed, stage)})
    counts = {r["bucket"]: r["n"] for r in ranked.groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # a row for each bucket
    n = min(n, sum(counts.values()))
    shares = allocate([(b.name, b.weight) for b in buckets], {k: v for k, v in counts.items() if k}, n)
    quota = F.coalesce(*(F.when(F.col("bucket") == name, k) for name, k in shares.items()), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("bucket").orderBy("rank_", "full_name"))
    chosen = ranked.withColumn("chosen", nth <= quota)
    # the chosen come first, then the rest by rank: one order, cut at n
    return chosen.orderBy(F.col("chosen").desc(), "rank_", "full_name").limit(n).drop("chosen", "rank_")


def sample(pool: DataFrame, n: int, cfg: Sampling, stage: str = "all") -> DataFrame:
    """n of ``pool`` (full_name, stars) by the configured strategy."""
    if n <= 0:
        return pool.limit(0)
    if cfg.strategy == "top":
        return top(pool, n)
    return random(pool, n, cfg.seed, stage) if cfg.strategy == "random" else stratified(pool, n, cfg, stage)


# --- query groups: one after another, as those who belong to several leave the later pools


def _rank(names: Iterable[str], seed: int, stage: str) -> list[str]:
    import hashlib

    return sorted(names, key=lambda x: (hashlib.sha256(f"{seed}:{stage}:{x}".encode()).hexdigest(), x))


def _pick(stars: dict[str, int], n: int, cfg: Sampling, stage: str) -> list[str]:
    """``sample`` over a mapping."""
    n = min(n, len(stars))
    if cfg.strategy == "top":
        return sorted(stars, key=lambda x: (-stars[x], x))[:n]
    order = _rank(stars, cfg.seed, stage)
    if cfg.strategy == "random":
        return order[:n]
    bucket = {x: next((b.name for b in cfg.star_buckets if s >= b.min_stars and (b.max_stars is None or s <= b.max_stars)), None) for x, s in stars.items()}
    counts = pd.Series(bucket).value_counts().to_dict() if bucket else {}
    left = allocate([(b.name, b.weight) for b in cfg.star_buckets], counts, n)
    first, rest = [], []
    for x in order:
        if left.get(bucket[x], 0) > 0:
            left[bucket[x]] -= 1
            first.append(x)
        else:
            rest.append(x)
    return (first + rest)[:n]


def plan(pool: pd.DataFrame, everyone: int, queries: Sequence[Query], cfg: Sampling) -> list[str]:
    """The names that the query groups give, in their order; pool: full_name, stars, query_names."""
    target = min(cfg.repositories_per_run, everyone)
    stars = dict(zip(pool["full_name"], pool["stars"].fillna(0).astype(int)))
    groups: dict[str, set[str]] = {q.name: set() for q in queries}
    for name, found in zip(pool["full_name"], pool["query_names"]):
        for q in found:
            if q in groups:
                groups[q].add(name)
    targets = allocate([(q.name, q.weight) for q in queries], {q: len(v) for q, v in groups.items()}, target, renormalize=True)
    chosen: dict[str, None] = {}
    for q in queries:
        free = {x: stars[x] for x in groups[q.name] if x not in chosen}
        chosen.update(dict.fromkeys(_pick(free, targets[q.name], cfg, f"query:{q.name}")))
    return list(chosen)[:target]


def select_repositories(pool: DataFrame, queries: Sequence[Query], cfg: Sampling) -> DataFrame:
    """pool: full_name, stars, query_names of repositories not yet crawled.  ``pool`` of those selected, with place.

    The pool of the query groups is cut to ``candidate_pool_size`` and planned in one task (0 leaves it whole); the slots
    that the groups leave are filled from all that is unseen, by a distributed sample.
    """
    everyone = pool.count()
    target = min(cfg.repositories_per_run, everyone)
    bounded = pool
    if cfg.candidate_pool_size and everyone > cfg.candidate_pool_size:
        bounded = random(pool, cfg.candidate_pool_size, cfg.seed, "pool")
    names = bounded.select("full_name", "stars", "query_names", F.lit(1).alias("all")).groupBy("all").applyInPandas(
        lambda x: pd.DataFrame(enumerate(plan(x, everyone, queries, cfg)), columns=["place", "chosen"]), "place long, chosen string"
    )
    first = pool.join(names, F.col("full_name") == F.col("chosen")).drop("chosen")
    missing = target - first.count()
    if missing <= 0:
        return first
    rest = pool.join(names.select("chosen"), F.col("full_name") == F.col("chosen"), "left_anti")
    filled = sample(rest, missing, cfg, "fill").select(*pool.columns)
    rank = (F.row_number().over(Window.orderBy(seeded_rank(F.col("full_name"), cfg.seed, "fill"), "full_name")) + (target - missing) - 1).cast("long")
    return first.select("place", *pool.columns).unionByName(filled.withColumn("place", rank).select("place", *pool.columns)).select(*pool.columns, "place")
