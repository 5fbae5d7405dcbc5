import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
CLASH = ("row_", "fp", "content", "own_content", "keys", "gone", "gone_id", "lines", "t", "base", "spans", "live", "n_rows", "quality_text", "quality_kept", "shard", "piece", "length", "part", "kind", "chunk", "ids", "id", "root")

WORDS = ["the", "of", "and", "Stein", "árbol", "niño", "über", "cœur", "token", "data", "river", "Mountain", "code,", "light.", "winter", "seven", "paper", "glass"]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", str(rnd.randrange(50))]) for _ in range(n))


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared lines, secrets, junk, and all special cases."""
    rnd = random.Random(seed)
    texts = ["\n".join(prose(rnd, rnd.randrange(5, 60)) for _ in range(rnd.randrange(1, 6))) for _ in range(n)]
    shared = "This line stands in very many of the documents here."
    for i in range(0, n, 4):
        texts[i] += f"\n  {shared.upper() if i % 8 else shared}\t\n" + texts[i]
    long = prose(rnd, 400)
    words = long.split(" ")
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (20, 200, 390)]
    texts += [long, long, *near, long.upper()]
    texts += ["", " \n\t ", None, "one", "one two\x0bthree four", "a" * 3000, "ab " * 4000, "\n" * 50, "é" * 25, "É" * 25, "éx y z", "\x00\x1c nul"]
    texts += ["x password = abc123def AKIA" + "Q" * 16 + " deadbeefdeadbeefdeadbeef01 token=token:abcdef", 'api_key: "s3cr3t+value/="', "passworſd=abcdefgh", "my ghp_AbCdEf0123456789abcDEFghi"]
    texts += ["%%% ### $$$ " * 30, "a | b | c | d | e | f", prose(rnd, 70) + "\n" + "HEY!! YOU!! " * 40]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["src0", "src1", "own/x", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "a null id", None, None, 9), (None, None, None, None, None), (-5, texts[0], "en", "src0", 1)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark, docs):
    """The same with columns that operators use themselves."""
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASH)).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]
