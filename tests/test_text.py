"""Cleaning and gates against Python's own string methods."""

import random
import re
import string

from pyspark.sql import functions as F

from sievecraft.functions import paths, records, text

PARTS = ["a", "B ", "\n", "\r\n", "\r", "\t", " ", "\v", "\f", "\x1c", "\x1e", "\x85", "\u2028", "\u3000", "\u00a0", "\ufeff", "\u200b", "é", "😀", "x = 1", "\n\n\n"]


def _texts(n=1500, seed=5):
    rnd = random.Random(seed)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(14))) for _ in range(n)] + [c + "a" + c + "\n" + c + "b" + c for c in spaces]


def _clean(t):
    t = re.sub("\r\n?", "\n", t.lstrip("\ufeff"))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x.rstrip() for x in t.split("\n"))).strip()


def test_clean_and_lines(spark):
    texts = _texts()
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("c", text.clean(F.col("t")))
    rows = frame.select("t", "c", text.non_empty_lines(F.col("c")).alias("n"), text.repeated_line_ratio(F.col("c")).alias("r")).collect()
    for row in rows:
        c = _clean(row.t)
        assert row.c == c, repr(row.t)
        lines = [x.strip() for x in c.splitlines() if x.strip()]
        assert row.n == len(lines), repr(row.t)
        assert row.r == (1.0 - len(set(lines)) / len(lines) if lines else 0.0)


def test_markers_look_at_the_first_lines_only(spark):
    late, early = "x\n" * 80 + "AUTO-Generated", "x\n" * 79 + "AUTO-Generated"
    rows = spark.createDataFrame([(late,), (early,)], "t string").select(text.has_marker(F.col("t"), ("auto-generated",))).collect()
    assert [r[0] for r in rows] == [False, True]


def test_split_and_bytes(spark):
    import hashlib
    import json

    rnd = random.Random(3)
    names = ["".join(rnd.choice(string.ascii_letters + "é/") for _ in range(12)) for _ in range(300)]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", records.split(F.col("n"), 42, 0.1), records.split(F.col("n"), 42, 0.0)).collect()
    for n, split, never in rows:
        share = int(hashlib.sha256(f"42:{n}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF
        assert split == ("validation" if share < 0.1 else "train") and never == "train"
    texts = [t + '"\\/\x01\x1f\x7f' for t in _texts(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", records.record_bytes(F.col("t"))).collect()
    assert all(b == len((json.dumps({"text": t}, ensure_ascii=False) + "\n").encode()) for t, b in rows)


def test_record_bytes_with_metadata(spark):
    import json

    frame = spark.createDataFrame([("a\nb", "r/é", None, 3)], "t string, repository string, license string, stars long")
    meta = F.struct("repository", "license", "stars")
    got = frame.select(records.record_bytes(F.col("t"), meta, 3)).first()[0]
    assert got == len((json.dumps({"text": "a\nb", "metadata": {"repository": "r/é", "license": None, "stars": 3}}, ensure_ascii=False) + "\n").encode())


def test_paths(spark):
    rows = [("src/a.py", True), ("build.py", True), ("build", False), ("Build/x.py", False), ("a/BUILD/b/x.PY", False), ("a/x.PY", True), ("a/x.txt", False), ("build/build.py", False)]
    got = spark.createDataFrame(rows, "p string, e boolean").select("p", "e", paths.eligible(F.col("p"), (".py",), {"build"}).alias("g")).collect()
    assert all(r.e == r.g for r in got), got


def test_invalid_utf8(spark):
    rnd = random.Random(2)
    raw = [bytes(rnd.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x80, 0xFF]) for _ in range(rnd.randrange(9))) for _ in range(400)]
    rows = spark.createDataFrame([(bytearray(r),) for r in raw], "r binary").select("r", records.utf8(F.col("r"))).collect()
    assert all(t == bytes(r).decode("utf-8", "replace") for r, t in rows)


def test_long_runs_cost_their_length(spark):
    """A million blanks inside a line, and strings that begin a credential at every character."""
    import time

    from sievecraft.functions import credentials

    texts = ["a" + " " * 1_000_000 + "b  \n c\t\n", "/" * 300_000, "eyJ" * 200_000, "token " * 200_000, '"' * 500_000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    frame.limit(0).select(text.clean(F.col("t"))).collect()
    began = time.perf_counter()
    got = {r.i: r for r in frame.select("i", text.clean(F.col("t")).alias("c"), F.size(credentials.findings(F.col("t"))).alias("n")).collect()}
    assert time.perf_counter() - began < 20 and got[0].c == "a" + " " * 1_000_000 + "b\n c" and all(r.n == 0 for r in got.values())
    lines = ["x //host/a/:_authToken=abc", "// no", "a //b //c/:_authToken=x", "//:_authToken=a", "eyJab.cd.", "xeyJab.cd.e", "eyJ.ab.c", "x.eyJab_.c-d.", "eyJab..", " //h/:_authToken=a"]
    found = frame.sparkSession.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string").select("i", credentials.findings(F.col("t")).alias("f")).collect()
    import re

    old = {"NPM tokens": re.compile(r"//[^\n\r\u0085  ]+/:_authToken=[A-Za-z0-9-]+"), "JSON Web Token": re.compile(r"eyJ[A-Za-z0-9_=-]+\.[A-Za-z0-9_=-]+\.[A-Za-z0-9_.+/=-]*")}
    for r in found:
        assert {x.type for x in r.f} == {k for k, p in old.items() if p.search(lines[r.i])}, lines[r.i]
