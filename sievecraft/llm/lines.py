"""Line deduplication that stays reversible: sharded cuckoo filters backed by exact reference counts.

A line's key is a 128-bit hash of the stripped, lower-cased line.  Keys are dealt into shards.  A shard has the exact
references (a row for each key and document that holds it), the counts of the keys that enough documents share, and a
cuckoo filter of these.  ``LineIndex.insert`` and ``LineIndex.delete`` read and write anew only the shards that hold a key
of the documents that come or go; the others stay where an earlier version wrote them.  So what a document put in can be
taken out again, and lines that were dropped for its sake come back.

To find the lines that go, the keys of all documents are dealt to their shards, those of a shard with many (a line that a
third of all documents hold) in parts of bounded size; each part is tested by the shard's filter and what passes by the
shard's exact counts, both of bounded size.

Results for special cases: a null or empty text is one empty line, which is too short to be dropped; a document is all
rows of one doc_id (null: a document of its own, the smallest); repeated rows count once and each get their row; of
several rows of the keeper every row keeps its lines; lines and texts of any length are taken whole; an empty table gives
an empty index and result; other columns pass through ``stage`` untouched, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, saved, shared_folder, unpacked, whole_text


def line_key(line: bytes, least: int) -> bytes | None:
    """16 bytes for the key of a line in UTF-8; None if the key is shorter than ``least`` code points."""
    key = line.strip()  # of bytes: the white space of the contract
    if len(key) < 4 * least and len(key.decode()) < least:
        return None
    return xxhash.xxh3_128_digest(key.lower())


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each key has two buckets, so it can be found, added and deleted in them.

    A key is 16 bytes.  Keys that find no room after many moves go to an exact, counted overflow, so none is ever lost,
    also where several keys share buckets and fingerprint.
    """

    SLOTS, MOVES = 4, 200

    def __init__(self, capacity: int) -> None:
        self.size = 1 << max(2, int(capacity / (self.SLOTS * 0.85))).bit_length()
        self.slots = np.zeros((self.size, self.SLOTS), np.uint16)
        self.over: Counter[tuple[int, int]] = Counter()

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = (int.from_bytes(key[:2], "little") % 0xFFFF) + 1
        first = int.from_bytes(key[2:8], "little") & (self.size - 1)
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return (place ^ (mark * 0x5BD1E995)) & (self.size - 1)

    def add(self, key: bytes) -> None:
        mark, a, b = self._places(key)
        for place in (a, b):
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = mark
                return
        place = a
        for move in range(self.MOVES):
            slot = (mark + move) % self.SLOTS
            mark, self.slots[place, slot] = int(self.slots[place, slot]), mark
            place = self._other(place, mark)
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = mark
                return
        self.over[min(place, self._other(place, mark)), mark] += 1

    def delete(self, key: bytes) -> bool:
        """Takes out one entry of a key that was added before."""
        mark, a, b = self._places(key)
        for place in (a, b):
            held = np.flatnonzero(self.slots[place] == mark)
            if len(held):
                self.slots[place, held[0]] = 0
                return True
        entry = (min(a, b), mark)
        if entry not in self.over:
            return False
        self.over[entry] -= 1
        if not self.over[entry]:
            del self.over[entry]
        return True

    def has(self, key: bytes) -> bool:
        mark, a, b = self._places(key)
        return mark in self.slots[a] or mark in self.slots[b] or (min(a, b), mark) in self.over

    def has_all(self, keys: np.ndarray) -> np.ndarray:
        """``has`` for an array of shape (n, 16) of bytes."""
        mark = (keys[:, :2].copy().view("<u2").ravel().astype(np.int64) % 0xFFFF) + 1
        place = np.zeros((len(keys), 8), np.uint8)
        place[:, :6] = keys[:, 2:8]
        a = (place.view("<u8").ravel() & np.uint64(self.size - 1)).astype(np.int64)
        b = (a ^ (mark * 0x5BD1E995)) & (self.size - 1)
        found = (self.slots[a] == mark[:, None]).any(1) | (self.slots[b] == mark[:, None]).any(1)
        for low, m in self.over:
            found |= (np.minimum(a, b) == low) & (mark == m)
        return found

    def to_bytes(self) -> bytes:
        over = np.array([(*k, n) for k, n in sorted(self.over.items())], "<i8").reshape(-1, 3)
        return self.size.to_bytes(8, "little") + self.slots.astype("<u2").tobytes() + over.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        out = cls(1)
        out.size = int.from_bytes(raw[:8], "little")
        end = 8 + out.size * cls.SLOTS * 2
        out.slots = np.frombuffer(raw[8:end], "<u2").reshape(out.size, cls.SLOTS).copy()
        out.over = Counter({(int(a), int(b)): int(n) for a, b, n in np.frombuffer(raw[end:], "<i8").reshape(-1, 3)})
        return out


def shard_of(key: Column, n_shards: int) -> Column:
    """From the key's last two bytes, so that tasks can tell it too."""
    return (F.conv(F.hex(F.substring(key, 15, 2)), 16, 10).cast("int") % n_shards).cast("int")


def document_keys(docs: DataFrame, least: int = 20, text: str = "text") -> DataFrame:
    """doc_id, keys: the distinct keys of every row."""

    @F.pandas_udf("array<binary>")
    def keys(texts: pd.Series) -> pd.Series:
        return pd.Series([list({k for line in t.encode().split(b"\n") if (k := line_key(line, least))}) for t in texts], dtype=object)

    return docs.select("doc_id", keys(whole_text(text)).alias("keys"))


def references(docs: DataFrame, least: int = 20, text: str = "text") -> DataFrame:
    """The exact table: a row (key, doc_id) for every key of a document."""
    return document_keys(docs, least, text).select(F.explode("keys").alias("key"), "doc_id").distinct()


def counted(refs: DataFrame, least_documents: int) -> DataFrame:
    """key, n_documents, keeper of the keys that enough documents hold; counts combine before the shuffle."""
    return refs.groupBy("key").agg(F.count("*").alias("n_documents"), F.max("doc_id").alias("keeper")).filter(F.col("n_documents") >= least_documents)


def shard_count(n_keys: int, per_shard: int = 50_000) -> int:
    return max(1, min(1 << 16, -(-n_keys // per_shard)))


_FILTER = "shard int, n long, filter binary"


def _update_filter(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after a change.  keys: all keys shared before or now (``before``, ``now``)."""
    now, n = keys["now"].to_numpy(bool), int(keys["now"].sum())
    made = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else None
    if made is None or n > 0.9 * made.size * made.SLOTS:  # new, or too full: all that the shard shares
        made, add = CuckooFilter(2 * n + 1000), now  # room for later insertions
    else:
        before = keys["before"].to_numpy(bool)
        add = now & ~before
        for key in sorted(keys["key"][before & ~now]):
            made.delete(key)
    for key in sorted(keys["key"][add]):
        made.add(key)
    return pd.DataFrame({"shard": [int((keys if len(keys) else old)["shard"].iloc[0])], "n": [n], "filter": [made.to_bytes()]})


class LineIndex:
    """References, counts and filters of a corpus by shard, in the shared folder; a change gives a new index and leaves the
    old one as it is.  ``held`` says which version of the files has which shards."""

    TABLES = ("refs", "shared", "filters")

    def __init__(self, docs: DataFrame, n_shards: int, least: int, least_documents: int, folder: str, held: dict[str, list[int]]) -> None:
        self.spark, self.n_shards, self.least, self.least_documents, self.folder, self.held = docs.sparkSession, n_shards, least, least_documents, folder, held
        kind = docs.schema["doc_id"].dataType.simpleString()
        self.schemas = {"refs": f"key binary, doc_id {kind}, shard int", "shared": f"key binary, n_documents long, keeper {kind}, shard int", "filters": "n long, filter binary, shard int"}

    @classmethod
    def of(cls, docs: DataFrame, n_shards: int | None = None, least: int = 20, least_documents: int = 3) -> LineIndex:
        refs = saved(references(docs, least))
        out = cls(docs, n_shards or shard_count(refs.count()), least, least_documents, f"{shared_folder(docs.sparkSession)}/lines-{uuid.uuid4()}", {})
        return out._with(out._sharded(refs), list(range(out.n_shards)))

    def table(self, name: str, of: list[int] | None = None) -> DataFrame:
        """A table's rows of all shards, or of those listed; other shards' files are not read."""
        out = self.spark.createDataFrame([], self.schemas[name])
        for version, shards in self.held.items():
            wanted = [x for x in shards if of is None or x in set(of)]
            if wanted:
                found = self.spark.read.schema(self.schemas[name]).parquet(f"{self.folder}/{version}/{name}")
                out = out.union(found if len(wanted) == self.n_shards else found.filter(F.col("shard").isin(wanted)))
        return out

    def shared(self) -> DataFrame:
        """key, n_documents, keeper of the keys that lose lines."""
        return self.table("shared").drop("shard")

    def _sharded(self, refs: DataFrame) -> DataFrame:
        return refs.withColumn("shard", shard_of(F.col("key"), self.n_shards))

    def _write(self, rows: DataFrame, version: str, name: str) -> None:
        columns = [c.split()[0] for c in self.schemas[name].split(", ")]
        rows.select(*columns).write.partitionBy("shard").parquet(f"{self.folder}/{version}/{name}")

    def _with(self, refs: DataFrame, touched: list[int]) -> LineIndex:
        """The index with other references of the touched shards."""
        version, salt = uuid.uuid4().hex, F.pmod(F.xxhash64("doc_id"), F.lit(8))
        held = {v: [x for x in shards if x not in set(touched)] for v, shards in self.held.items()}
        out = LineIndex.__new__(LineIndex)
        out.__dict__ = self.__dict__ | {"held": {v: x for v, x in held.items() if x} | {version: touched}}
        self._write(refs.repartition("shard", salt), version, "refs")
        written = self.spark.read.schema(self.schemas["refs"]).parquet(f"{self.folder}/{version}/refs")
        now = counted(written, self.least_documents).withColumn("shard", shard_of(F.col("key"), self.n_shards))
        self._write(now.repartition("shard"), version, "shared")
        now = self.spark.read.schema(self.schemas["shared"]).parquet(f"{self.folder}/{version}/shared")
        states = now.select("shard", "key", F.lit(False).alias("before"), F.lit(True).alias("now")).union(self.table("shared", touched).select("shard", "key", F.lit(True), F.lit(False)))
        states = states.groupBy("shard", "key").agg(F.max("before").alias("before"), F.max("now").alias("now"))
        filters = self.table("filters", touched).groupBy("shard").cogroup(states.groupBy("shard")).applyInPandas(_update_filter, _FILTER)
        self._write(filters, version, "filters")
        return out

    def _touched(self, refs: DataFrame) -> list[int]:
        return sorted(r[0] for r in refs.select("shard").distinct().collect())  # numbers of shards, 65,536 at most

    def insert(self, docs: DataFrame) -> LineIndex:
        fresh = saved(self._sharded(references(docs, self.least)))
        touched = self._touched(fresh)
        return self._with(self.table("refs", touched).union(fresh).distinct(), touched) if touched else self

    def delete(self, docs: DataFrame) -> LineIndex:
        """Without the documents in ``docs``; if it has their text, only the shards of their keys are read."""
        gone = docs.select(F.col("doc_id").alias("gone")).distinct()
        if "text" in docs.columns:
            held = self._sharded(references(docs, self.least))
        else:
            held = self.table("refs").join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi")
        touched = self._touched(held)
        return self._with(self.table("refs", touched).join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti"), touched) if touched else self

    def dropped(self, docs: DataFrame | None = None, part_size: int = 200_000) -> DataFrame:
        """doc_id, gone: for the documents (all that are held, or ``docs``) that lose lines, the keys of those lines."""
        each = self.table("refs") if docs is None else self._sharded(references(docs, self.least))
        kind = each.schema["doc_id"].dataType
        sizes = each.groupBy("shard").agg(F.ceil(F.count("*") / part_size).cast("int").alias("parts"))
        # a shard's filter and counts go to each of its parts
        exact = self.table("shared").groupBy("shard").agg(F.collect_list(F.struct("key", F.col("keeper").cast("string").alias("keeper"))).alias("exact"))
        held = sizes.join(self.table("filters").select("shard", "filter"), "shard").join(exact, "shard")
        held = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("shard", "part", "filter", "exact")
        each = each.join(F.broadcast(sizes.toDF("shard", "parts")), "shard")  # a row for each shard, 65,536 at most
        each = each.select("shard", F.pmod(F.xxhash64("doc_id", "key"), F.col("parts")).cast("int").alias("part"), "key", F.col("doc_id").cast("string").alias("doc_id"))
        each, held = each.toDF(*each.columns), held.toDF(*held.columns)

        def test(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(asked) or not len(held):
                return pd.DataFrame({"key": [], "doc_id": []}, dtype=object)
            keys = np.frombuffer(b"".join(asked["key"]), np.uint8).reshape(-1, 16)
            maybe = asked[CuckooFilter.from_bytes(held["filter"].iloc[0]).has_all(keys)]
            keeper = {bytes(x["key"]): x["keeper"] for x in held["exact"].iloc[0]}
            gone = [k in keeper and d != keeper[k] for k, d in zip(map(bytes, maybe["key"]), maybe["doc_id"])]
            return maybe.loc[gone, ["key", "doc_id"]]

        by = ["shard", "part"]
        gone = each.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(test, "key binary, doc_id string")
        return gone.groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.collect_set("key").alias("gone"))


def drop_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """row_ (the whole row), doc_id, lines_n, lines_dropped and lines_text, the text that stays; ``index`` holds ``docs``."""
    least = index.least

    @F.pandas_udf("struct<n long, dropped long, text string>")
    def kept(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        out = []
        for t, keys in zip(texts, gone):
            if keys is None:
                out.append((t.count("\n") + 1, 0, t))
                continue
            lines, held = t.encode().split(b"\n"), set(keys)
            stay = [line for line in lines if line_key(line, least) not in held]
            out.append((len(lines), len(lines) - len(stay), b"\n".join(stay).decode()))
        return pd.DataFrame(out, columns=["n", "dropped", "text"])

    gone = index.dropped().select(F.col("doc_id").alias("gone_id"), "gone")
    # as if not deterministic, so that a filter on what it gives does not run it a second time, in workers of its own
    once = kept.asNondeterministic()
    joined = packed(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").withColumn("lines", once(whole_text("row_.text"), "gone"))
    return joined.select("row_", "doc_id", F.col("lines.n").alias("lines_n"), F.col("lines.dropped").alias("lines_dropped"), F.col("lines.text").alias("lines_text"))


def stage(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that other documents keep; a document that loses all its text goes."""
    out = drop_lines(docs, LineIndex.of(docs))
    out = out.filter((F.col("lines_dropped") == 0) | F.col("lines_text").rlike(r"[^\x20\x09-\x0D]"))
    return unpacked(out, docs.columns, F.col("lines_dropped") > 0, F.col("lines_text"))


def query(docs: DataFrame) -> DataFrame:
    """The rows of ``op6_line_dedup``."""
    docs = docs.select("doc_id", "text")
    return drop_lines(docs, LineIndex.of(docs)).select("doc_id", F.col("lines_n").alias("n_lines"), F.col("lines_dropped").alias("n_dropped"), F.sha2("lines_text", 256).alias("kept_sha256"))
