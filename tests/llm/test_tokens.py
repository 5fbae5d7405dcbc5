"""BPE, packing and token output."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
from tokenizers import Tokenizer  # noqa: E402

from sievecraft.llm import bpe, packing  # noqa: E402
from sievecraft.llm.tokens import Tokens  # noqa: E402

PARTS = ["a", "b", "the", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", "é", "ß", "日本", "😀", "1", "23", "'s", "'LL", "!!", "—", "​", "aaaa", "A", "İ", "́", "\x00", "٣", "Ⅷ", "한국", "　", "½", "<|endoftext|>", "“x”"]


def fuzz(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(30))) for _ in range(n)]


def library(name):
    with open(P.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe_is_that_of_the_library(name):
    own, theirs = bpe.BPE.load(P.path(name), P.PATTERN), library(name)
    rnd = random.Random(4)
    texts = fuzz(4000, 1) + ["", "a" * 5001, " " * 3003, "ab" * 3001 + "!" * 333, "=-" * 1500, "日本" * 700, "".join(rnd.choice("abeinorst") for _ in range(20_000))]
    for text, got in zip(texts, own.encode_batch(texts)):
        ids = np.frombuffer(got, "<u4").tolist()
        assert ids == theirs.encode_ordinary(text), text[:80]
        assert own.decode(ids) == text.encode()


def test_a_merge_that_makes_a_lower_rank():
    """Ranks that no training gives: "ab" + "c" ranks below "ab", so order within a rank matters."""
    tokens = [bytes([b]) for b in range(256)] + [b"bx", b"abab", b"aba", b"ab", b"ca", b"cab", b"abc", b"aa", b"aaa", b"ba"]
    rnd = random.Random(6)
    for trial in range(30):
        tail = tokens[256:]
        rnd.shuffle(tail)
        ranks = {t: i for i, t in enumerate(tokens[:256] + tail)}
        own = bpe.BPE(ranks, P.PATTERN)
        theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for text in ("".join(rnd.choice("aabbcx") for _ in range(rnd.randrange(1, 14))) for _ in range(60)):
            assert own.encode(text) == theirs.encode_ordinary(text), (trial, text)


def test_queue_gives_the_least_rank():
    rnd = random.Random(5)
    for ranks in (1, 63, 64, 65, 5000, 300_000):
        queue, model = bpe.RankQueue(ranks), {}
        for _ in range(400):
            if rnd.random() < 0.6 or not model:
                r = rnd.randrange(ranks)
                queue.push(r, [1])
                model.setdefault(r, []).append(1)
            else:
                assert queue.pop() == (min(model), model.pop(min(model)))
        while model:
            assert queue.pop() == (min(model), model.pop(min(model)))
        assert queue.pop() is None


def test_bpe_query(docs, clashing, empty, rows):
    theirs = library("byte_bpe_multi_50k.tiktoken")
    expected = Counter()
    for d, t in rows:
        ids = theirs.encode_ordinary(t or "")
        expected[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    for frame, chars in ((docs, 20_000_000), (clashing, 2000)):
        got = bpe.query(frame, batch_chars=chars).collect()
        assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == expected
    assert bpe.query(empty).count() == 0
    back = bpe.decode(bpe.encode(docs)).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back) == Counter((d, (t or "").encode()) for d, t in rows)


def test_fast_ids_are_the_librarys():
    tokens, theirs = Tokens(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert tokens.fast is not None
    for text in fuzz(4000, 2):
        assert tokens.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids, text
    other = Tokens(P.path("word_bpe_49k.json"))
    assert other.fast is None and len(other.encode("Hello there"))


def brute_pieces(rows):
    theirs = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out, total = Counter(), 0
    for d, t in rows:
        ids = np.array(theirs.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        total += len(ids)
        at = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(at, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    return out, total


def test_best_fit_query(docs, clashing, empty, rows):
    expected, total = brute_pieces(rows)
    for frame in (docs, clashing):
        got = packing.query_best_fit(frame).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for s in sequences.values():
            s.sort()
            assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= 1024
        assert len(sequences) <= total / 1024 * 1.15 + 1
    assert packing.query_best_fit(empty).count() == 0


@pytest.mark.parametrize("open_bins", [1, 3, 50])
def test_bounded_best_fit_is_the_plain_rule(open_bins):
    rnd = random.Random(open_bins)
    bins, open_, used = packing.BoundedBestFit(100, open_bins), {}, 0
    for _ in range(2000):
        n = rnd.randrange(1, 101)
        found, place = bins.add(n)
        fitting = [b for b, free in open_.items() if free >= n]
        least = min((open_[b] for b in fitting), default=None)
        if least is None:
            assert (found, place) == (used, 0)
            open_[found], used = 100, used + 1
        else:
            assert open_[found] == least and place == 100 - least
        open_[found] -= n
        if not open_[found]:
            del open_[found]
        if len(open_) > open_bins:
            fullest = [b for b in open_ if open_[b] == min(open_.values())]
            gone = [b for b in fullest if b not in bins.at[open_[b]]]
            assert len(gone) == 1
            del open_[gone[0]]
        assert bins.open == len(open_) <= open_bins


def test_best_fit_decreasing_is_the_plain_rule():
    rnd = random.Random(7)
    for capacity in (1, 7, 64, 100):
        lengths = sorted((rnd.randrange(1, capacity + 1) for _ in range(300)), reverse=True)
        free = []
        for n, (found, place) in zip(lengths, packing.best_fit_decreasing(lengths, capacity)):
            least = min((f for f in free if f >= n), default=None)
            if least is None:
                assert (found, place) == (len(free), 0)
                free.append(capacity)
            assert free[found] == (least or capacity) and place == capacity - free[found]
            free[found] -= n


@pytest.mark.parametrize("per_row", [1, 5])
def test_matrices_round_trip(docs, clashing, rows, per_row):
    expected, total = brute_pieces(rows)
    got, seen = Counter(), 0
    for r in packing.packed_matrices(docs if per_row == 1 else clashing, rows=per_row).collect():
        matrix = np.frombuffer(r.ids, "<u2").reshape(r.n_rows, 1024)
        positions = np.frombuffer(r.positions, "<u2").reshape(r.n_rows, 1024)
        assert len(r.cu_seqlens) == len(r.doc_ids) + 1 and sum(r.row_segments) == len(r.doc_ids) and r.cu_seqlens[-1] == r.n_tokens
        k = 0
        for row in range(r.n_rows):
            at = 0
            for _ in range(r.row_segments[row]):
                n = r.cu_seqlens[k + 1] - r.cu_seqlens[k]
                assert (positions[row, at : at + n] == np.arange(n)).all()
                got[r.doc_ids[k], r.pieces[k], r.starts[k], n, zlib.crc32(matrix[row, at : at + n].astype("<u4").tobytes())] += 1
                at, k = at + n, k + 1
            assert at <= 1024 and (matrix[row, at:] == 0).all() and (positions[row, at:] == np.arange(1024 - at)).all()
        seen += r.n_tokens
    assert got == expected and seen == total


def test_empty_and_files(spark, docs, empty, tmp_path):
    assert packing.query_matrices(empty).count() == 0
    packing.write_matrices(docs, f"file://{tmp_path}/m", rows=8)
    written = spark.read.parquet(f"file://{tmp_path}/m")
    assert written.selectExpr("sum(n_rows)").first()[0] == packing.query_matrices(docs).count()
