"""Texts of megabytes, in one word, one line or very many: every operator takes them whole, in time linear in the text."""

import hashlib
import random
import time

import numpy as np
import pytest

from sievecraft.llm import bpe, lines, packing, pitman_yor, quality, secrets, simhash
from tests.llm.test_rules import base_counts, brute_lines, brute_spans, digest, sha
from tests.llm.test_simhash import brute_fingerprint

RND = random.Random(12)
LONG = {
    0: "a" * 1_000_000,
    1: " ".join(RND.choice(["alpha", "beta", "gamma"]) + str(RND.randrange(999)) for _ in range(150_000)),
    2: "\n".join(f"line number {i % 3000} is here, is it not" for i in range(30_000)),
    3: " ".join(f"token=abcdef{i:05d}" for i in range(10_000)),
    4: "#!%" * 200_000,
    5: " " * 500_000 + "x" + "\n" * 500_000,
    6: None,
}


@pytest.fixture(scope="module")
def long(spark):
    rows = [(i, t, "s") for i, t in LONG.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).cache()


def test_fingerprints(long):
    got = {r.doc_id: r.fingerprint for r in simhash.query(long).collect()}
    assert got == {i: f"{brute_fingerprint(t):016x}" for i, t in LONG.items()}


def test_rules(long):
    began = time.perf_counter()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.query(long).collect()}
    assert got == {i: base_counts(t) for i, t in LONG.items()}
    found = {r.doc_id: (r.n_assign, r.base_sha256) for r in secrets.query(long).collect()}
    spans = {i: brute_spans(t) for i, t in LONG.items()}
    assert found == {i: (sum(k == "assign" for _, _, k, _ in s), sha(digest(s))) for i, s in spans.items()}
    clean = {r.doc_id: r.text for r in secrets.redact(long).collect()}
    assert clean[3] == " ".join(["<secret>"] * 10_000) and clean[1] == LONG[1] and clean[6] is None
    assert time.perf_counter() - began < 90


def test_lines(long):
    assert {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.query(long).collect()} == set(brute_lines(list(LONG.items())))


def test_tokens(long):
    for r in bpe.query(long).collect():
        assert r.decoded_sha256 == hashlib.sha256((LONG[r.doc_id] or "").encode()).hexdigest()
    ends = {}
    for r in packing.query_best_fit(long).collect():
        ends.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        assert 0 < r.length <= 1024
    for found in ends.values():
        found.sort()
        assert [s for _, s, _ in found] == np.cumsum([0, *(n for _, _, n in found)])[:-1].tolist()
    assert set(ends) == set(LONG)


def test_scores(long):
    got = {r.doc_id: r.n_tokens for r in pitman_yor.query(long).collect()}
    assert got == {i: len((t or "").encode().lower().split()) + 1 for i, t in LONG.items()}
