"""Secret scans with corpus-wide ownership frequency.

Base rules find every assignment, access key and long hexadecimal run.  Two wider rules (other credential words, and
random-looking strings) only make candidates: each candidate's value is hashed, the hash is counted by distinct
repositories and owners over the whole corpus, and a candidate becomes a span only where its value belongs to few
owners and looks live; values that many owners share are examples from documentation.

Everything is built-in expressions.  The regular expressions run where the text is; only hashes, positions and keys are
shuffled, aggregated before the shuffle, so that a value copied into a third of all rows costs one row per task.

Results for special cases: null or empty texts have no spans; a null source is an owner of its own; rows that repeat
(id and text) get the same spans each; spans that begin together are ordered by kind, and a value with exactly the most
owners or repositories counts as live; texts of any length are read whole; an empty table gives an empty result; other
columns pass through ``redact`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, packed, running, saved, unpacked, whole_text


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_VALUE = r"[A-Za-z0-9+/_.=-]+"
_SET = r"""["']?\x20*[:=]\x20*["']?"""


def assignment(names: tuple[str, ...]) -> str:
    return "(" + "|".join(_either_case(n) for n in names) + ")" + _SET + f"({_VALUE})"


#: Kind, pattern, group of the value, least length of the value.  The order is the order of kinds.
BASE = (
    ("assign", assignment(("password", "passwd", "secret", "token", "api_?key")), 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
)
WIDER = (
    ("keyword", assignment(("pwd", "passphrase", "credentials?", "private_?key", "access_?key", "auth_?key")), 2, 8),
    ("random", "[A-Za-z0-9_-]{20,}", 0, 20),
)
KINDS = tuple(k for k, *_ in BASE + WIDER)


@dataclass(frozen=True)
class Ownership:
    """When a candidate counts as one owner's live credential."""

    max_owners: int = 2
    max_repositories: int = 3
    min_digits: int = 3
    min_distinct_chars: int = 10
    repository: str = "source"
    #: The owner is the repository's name up to this separator.
    owner_separator: str = "/"


def find(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches from the left, none overlapping, as array<struct<start, rank, end, kind, value>>; code points.

    The pieces between matches and the matches alternate, so their lengths add up to the positions.
    """
    rank = KINDS.index(kind)
    empty = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string,value:string>>)")
    parts = F.arrays_zip(F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def step(at: Column, x: Column, given: Column) -> tuple[Column, Column]:
        start = at + F.length(x["gap"])
        end = start + F.length(x["all"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        good = x["all"].isNotNull() & (F.length(x["value"]) >= least)
        return F.coalesce(end, start), F.when(good, F.array(span)).otherwise(empty)

    found = let(parts, lambda p: running(p, F.lit(0), empty, step)[0])
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    return F.sort_array(F.concat(*(find(text, *rule) for rule in BASE)))


def _looks_live(value: Column, own: Ownership) -> Column:
    digits = F.length(value) - F.length(F.translate(value, "0123456789", ""))
    return (digits >= own.min_digits) & (F.size(F.array_distinct(F.split(value, ""))) >= own.min_distinct_chars)


def candidates(text: Column, base: Column, own: Ownership) -> Column:
    """Spans of the wider rules that look live and overlap no base span."""
    mixed = lambda x: (x["kind"] != "random") | (x["value"].rlike("[a-z]") & x["value"].rlike("[A-Z]"))
    apart = lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    return F.filter(F.concat(*(find(text, *rule) for rule in WIDER)), lambda x: mixed(x) & _looks_live(x["value"], own) & apart(x))


def _key(text: str) -> list[Column]:
    return [F.col("doc_id").alias("k_id"), F.xxhash64(whole_text(text)).alias("k_text")]


def scan(docs: DataFrame, own: Ownership = Ownership(), text: str = "text") -> DataFrame:
    """One row for each document row: k_id, k_text (its key), base spans, candidates and owners; written once."""
    t = whole_text(text)
    repository = F.col(own.repository) if own.repository in docs.columns else F.lit(None).cast("string")
    found = docs.select(*_key(text), repository.alias("repository"), t.alias("t")).withColumn("base", base_spans(F.col("t")))
    # a value's hash stands for it from here on
    safe = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), F.sha2(x["value"], 256).alias("hash")))
    return saved(found.select("k_id", "k_text", "repository", safe(F.col("base")).alias("base"), safe(candidates(F.col("t"), F.col("base"), own)).alias("wider")))


def ownership(found: DataFrame, own: Ownership = Ownership()) -> DataFrame:
    """hash, n_documents, n_repositories, n_owners over all candidates, base ones included."""
    owner = F.substring_index("repository", own.owner_separator, 1)
    each = found.select("repository", owner.alias("owner"), F.explode(F.array_distinct(F.transform(F.concat("base", "wider"), lambda x: x["hash"]))).alias("hash"))
    by_repository = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("r"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_documents"), F.sum("r").alias("n_repositories"), F.count("*").alias("n_owners"))


def live_candidates(found: DataFrame, own: Ownership = Ownership()) -> DataFrame:
    """For each document key, the candidates that few owners have (``live``) and how many were examples."""
    few = ownership(found, own).select("hash", ((F.col("n_owners") <= own.max_owners) & (F.col("n_repositories") <= own.max_repositories)).alias("few"))
    each = found.filter(F.size("wider") > 0).dropDuplicates(["k_id", "k_text"]).select("k_id", "k_text", F.explode("wider").alias("x"))
    each = each.join(few, each["x"]["hash"] == few["hash"])
    return each.groupBy("k_id", "k_text").agg(F.sort_array(F.collect_list(F.when(F.col("few"), F.col("x")))).alias("live"), F.count_if(~F.col("few")).alias("n_example"))


def with_live(left: DataFrame, live: DataFrame) -> DataFrame:
    """``left`` (with k_id, k_text) and the live candidates of its keys."""
    live = live.select(F.col("k_id").alias("l_id"), F.col("k_text").alias("l_text"), "live", "n_example")
    return left.join(live, F.col("k_text").eqNullSafe(F.col("l_text")) & F.col("k_id").eqNullSafe(F.col("l_id")), "left").drop("l_id", "l_text")


def redact(docs: DataFrame, own: Ownership = Ownership(), mark: str = "<secret>") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; overlapping spans by one mark."""
    live, t = live_candidates(scan(docs, own), own), whole_text("row_.text")
    keyed = packed(docs).select("row_", *_key("row_.text"))
    bare = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    spans = F.when(F.col("live").isNull(), bare(F.col("base"))).otherwise(F.sort_array(F.concat(bare(F.col("base")), bare(F.col("live")))))

    def stretch(at: Column, part: Column) -> Column:
        """The text from ``at`` to the end of a block of spans, so that each span is cut from little."""
        last = F.array_max(F.transform(part, lambda x: x["end"]))
        return F.struct(at.alias("from"), F.substring(F.col("t"), at + 1, F.greatest(last - at, F.lit(0))).alias("text"))

    def step(at: Column, x: Column, given: Column) -> tuple[Column, Column]:
        piece = F.concat(F.substring(given["text"], at - given["from"] + 1, x["start"] - at), F.lit(mark))
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, F.array(piece)).otherwise(F.expr("cast(array() as array<string>)"))

    pieces, end = running(F.col("spans"), F.lit(0), F.expr("cast(array() as array<string>)"), step, stretch)
    clean = F.concat(F.array_join(pieces, ""), F.substring(F.col("t"), end + 1, F.length("t")))
    # texts are searched again after the join, so that only whole rows are shuffled
    done = with_live(keyed, live).withColumn("t", t).withColumn("base", base_spans(F.col("t"))).withColumn("spans", spans)
    return unpacked(done, docs.columns, F.size("spans") > 0, clean)


def query(docs: DataFrame, own: Ownership = Ownership()) -> DataFrame:
    """The rows of ``op5_secret_scans``."""
    found = scan(docs, own)
    digest = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.when(F.col("live").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "live")))
    return with_live(found, live_candidates(found, own)).select(
        F.col("k_id").alias("doc_id"), n("assign"), n("access"), n("hex"), F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(spans).alias("spans"), F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example")
    )
