"""The state machine of repositories, new -> processing -> crawled or failed, as functions from table to table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_CHARACTERS = 2000


def _where(repositories: DataFrame, test: Column, values: dict[str, Column]) -> DataFrame:
    """``values`` for the rows where ``test`` holds; columns that the table lacks are left out."""
    return repositories.withColumns({c: F.when(test, v).otherwise(F.col(c)) for c, v in values.items() if c in repositories.columns})


def recover(repositories: DataFrame) -> DataFrame:
    """What a broken run left in processing is new again."""
    return _where(repositories, F.col("status") == "processing", {"status": F.lit("new"), "updated_at": F.current_timestamp()})


def mark(repositories: DataFrame, names: DataFrame, status: str) -> DataFrame:
    """The named repositories (full_name, and error where the status is failed) in a new status."""
    errors = F.substring("error", 1, ERROR_CHARACTERS) if status == "failed" else F.lit(None).cast("string")
    named = names.select(F.col("full_name").alias("named"), errors.alias("new_error")).dropDuplicates(["named"])
    now = F.current_timestamp()
    values = {"status": F.lit(status), "updated_at": now, "last_error": F.col("new_error")}
    values |= {"processing": {"selected_at": now}, "crawled": {"crawled_at": now}}.get(status, {})
    joined = repositories.join(named, F.col("full_name") == F.col("named"), "left")
    return _where(joined, F.col("named").isNotNull(), values).select(repositories.columns)


def upsert(repositories: DataFrame, found: DataFrame) -> DataFrame:
    """New candidates are new; known ones keep their status and take the other columns of ``found`` (full_name: distinct)."""
    fresh = [c for c in found.columns if c != "full_name"]
    theirs = found.select(F.col("full_name").alias("f_name"), *(F.col(c).alias(f"f_{c}") for c in fresh))
    joined = repositories.join(theirs, F.col("full_name") == F.col("f_name"), "full_outer")
    out = {}
    for c in repositories.columns:
        own = F.col(c)
        if c == "full_name":
            out[c] = F.coalesce(own, "f_name")
        elif c == "status":
            out[c] = F.coalesce(own, F.lit("new"))
        else:
            out[c] = F.when(F.col("f_name").isNotNull(), F.col(f"f_{c}")).otherwise(own) if c in fresh else own
    return joined.select(*(x.alias(c) for c, x in out.items()))


def progress(stored: DataFrame, query_name: str, query_text: str) -> tuple[int, bool]:
    """The next page and whether the query is exhausted; a query whose text has changed begins anew."""
    row = stored.filter((F.col("query_name") == query_name) & (F.col("query_text") == query_text)).select("next_page", "exhausted").first()
    return (1, False) if row is None else (int(row[0]), bool(row[1]))


def set_progress(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` in the place of those with the same query_name."""
    return stored.join(rows.select("query_name").distinct(), "query_name", "left_anti").select(stored.columns).unionByName(rows.select(stored.columns))


def register(registry: DataFrame, accepted: DataFrame, structural: bool) -> DataFrame:
    """The registry with the hashes of accepted files (repository, file_path, split, exact_hash, structural_hash); exact
    hashes always, so that later runs know them.  A hash that is there stays as it is."""
    kinds = ["exact", *(["structural"] if structural else [])]
    now = F.current_timestamp()
    each = [accepted.select(F.lit(k).alias("hash_type"), F.col(f"{k}_hash").alias("hash_value"), "repository", "file_path", "split", now.alias("created_at")) for k in kinds]
    fresh = each[0] if len(each) == 1 else each[0].unionByName(each[1])
    first = F.min(F.struct("repository", "file_path", "split", "created_at")).alias("x")
    fresh = fresh.groupBy("hash_type", "hash_value").agg(first).select("hash_type", "hash_value", "x.*")
    return registry.unionByName(fresh.join(registry.select("hash_type", "hash_value"), ["hash_type", "hash_value"], "left_anti").select(registry.columns))
