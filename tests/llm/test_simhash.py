import inspect
import math
import random
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from sievecraft.llm import simhash
from sievecraft.llm.components import components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(text, k):
    w = words(text)
    return [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []


def brute_fingerprint(text):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 4)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_query(docs, clashing, rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    root = classes(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = defaultdict(lambda: None)
    for (d, _), r in zip(rows, root):
        if d is not None and (least[r] is None or d < least[r]):
            least[r] = d
    expected = Counter((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, root))
    for frame in (docs, clashing):
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.query(frame).collect()) == expected


def test_empty(empty):
    assert simhash.query(empty).count() == 0 and simhash.stage(empty).count() == 0


def test_every_choice_of_blocks_and_every_cut_finds_all_links(spark):
    rnd = random.Random(8)
    values = [rnd.getrandbits(64) for _ in range(40)]
    for v in values[:30]:
        values += [v ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 7))) for _ in range(3)]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    root = classes(len(values), lambda i, j: (values[i] ^ values[j]).bit_count() <= 4)
    expected = {frozenset(signed[i] for i in range(len(values)) if root[i] == r) for r in root}
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    for r, size in ((1, 4096), (2, 4096), (3, 4096), (1, 3)):
        found = {x.node: x.root for x in components(simhash.stars(nodes, simhash.block_masks(64, 4, r), 4, size)).collect()}
        groups = defaultdict(set)
        for v in signed:
            groups[found.get(v, v)].add(v)
        assert {frozenset(g) for g in groups.values()} == expected, (r, size)


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5, 4)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 300)}


def test_tree_follows_the_radius():
    rnd = random.Random(2)
    values = [rnd.getrandbits(16) for _ in range(500)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 1 << 16, 999):
        assert sorted(tree.within(q, 3)) == sorted({v for v in values if (v ^ q).bit_count() <= 3})


def brute_groups(rows):
    texts = {}
    for d, t in rows:
        texts.setdefault(" ".join(words(t)), []).append(d)
    keys = list(texts)
    sets = [set(shingles(k, 5)) for k in keys]
    root = classes(len(keys), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 and bool(sets[i]))
    groups = defaultdict(list)
    for k, r in zip(keys, root):
        groups[r] += texts[k]
    return groups


def test_stage_keeps_one_of_each_group(docs, clashing, rows):
    groups = brute_groups(rows)
    expected = Counter(min((d for d in g if d is not None), default=None) for g in groups.values())
    assert sum(expected.values()) < len(rows)
    for frame in (docs, clashing):
        out = simhash.stage(frame)
        assert out.columns == frame.columns
        assert Counter(r.doc_id for r in out.collect()) == expected
    assert all(r.fp == "own fp" for r in simhash.stage(clashing).collect())


def test_stage_with_null_ids_and_ids_of_several_texts(spark):
    """Near copies without an id go too; texts that share an id are told apart; a row that repeats very often is one."""
    rnd = random.Random(6)

    def copies(n):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
        return [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(10, 10 + 40 * n, 40)]

    a, b, c, d, e = (copies(3) for _ in range(5))
    rows = [(5, a[0]), (5, b[0]), (3, a[1]), (4, b[1]), (None, a[2]), (None, c[0]), (None, c[1]), (9, c[2]), (None, d[0]), (None, d[1])]
    rows += [(20, e[0])] * 300 + [(21, e[1]), (None, e[1].upper()), (5, e[2])]
    expected = Counter(min((x for x in g if x is not None), default=None) for g in brute_groups(rows).values())
    assert expected == {3: 1, 4: 1, 9: 1, None: 1, 5: 1}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(r.doc_id for r in simhash.stage(frame).collect()) == expected


def test_parts_of_a_group_lose_no_link(docs):
    whole = {(r.id, r.root) for r in simhash.similar_groups(docs).collect()}
    cut = {(r.id, r.root) for r in simhash.similar_groups(docs, tree_size=2, part_size=2).collect()}
    assert whole == cut and any(a != b for a, b in whole)


def test_copies_that_differ_in_how_often_a_line_repeats(spark):
    rnd = random.Random(0)
    rows = []
    for i in range(0, 120, 2):
        body, line = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(n)) for n in (300, 10))
        rows += [(i, "\n".join([body, line])), (i + 1, "\n".join([body] + [line] * 30))]
    kept = simhash.stage(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(range(0, 120, 2))


def test_the_radius_loses_fewer_links_than_the_bands():
    """The chance that a bit differs between sets of similarity 0.8 or more, over all small sizes of the sets."""

    def differs(common, a, b):
        chance = lambda x, n, all_: sum(math.comb(n, k) for k in range(n + 1) if 2 * (x + k) > all_) / 2**n
        total = 0.0
        for x in range(common + 1):
            p, q = chance(x, a, common + a), chance(x, b, common + b)
            total += math.comb(common, x) / 2**common * (p * (1 - q) + q * (1 - p))
        return total

    p = max(differs(m, a, b) for m in range(1, 31) for a in range(m // 4 + 1) for b in range(m // 4 - a + 1))
    radius = inspect.signature(simhash.similar_groups).parameters["radius"].default
    beyond = sum(math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(radius + 1, 65))
    assert p == 3 / 16 and beyond < 0.1 * (1 - 0.8**4) ** 20


def test_hot_keys_are_joined_by_broadcast(spark):
    from sievecraft.llm.common import join_unique

    left = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(900)], "x long, k long")
    right = left.groupBy(F.col("k").alias("o")).agg(F.count("*").alias("n"), F.max("x").alias("m"))
    plain = sorted(map(tuple, left.join(right, F.col("k") == F.col("o")).collect()))
    joined = join_unique(left, "k", right, "o", "n", share=10, least=50)
    assert sorted(map(tuple, joined.collect())) == plain and "Union" in joined._jdf.queryExecution().toString()


def test_scratch_tables_go(spark):
    import os

    from sievecraft.llm.common import Scratch

    scratch = Scratch(spark)
    for i in range(3):
        scratch.keep(spark.range(i))
    last = scratch.keep_only(spark.range(7))
    here = scratch.folder.removeprefix("file:")
    assert last.count() == 7 and os.listdir(here) == ["3"]
    scratch.drop()
    assert not os.path.exists(here)
