"""Candidate repositories: filters, identity, merged search hits, the unfinished pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Bucket, RepositoryFilter
from ..schemas import REPOSITORY

UNFINISHED = ("new", "failed")


def identity(full_name: Column, login: Column, name: Column) -> Column:
    """The full name, else login/name; a part that is missing reads None."""
    part = lambda c: F.coalesce(c, F.lit("None"))
    return F.coalesce(F.nullif(full_name, F.lit("")), F.concat(part(login), F.lit("/"), part(name)))


def parse(hits: DataFrame, column: str = "repo") -> DataFrame:
    """``hits`` with the repository's JSON as a struct; rows whose JSON is broken go."""
    parsed = hits.withColumn("r", F.from_json(column, REPOSITORY, {"mode": "PERMISSIVE"})).filter("r is not null")
    known = F.col("r.full_name").isNotNull() | F.col("r.name").isNotNull()
    return parsed.filter(known).withColumn("full_name", identity(F.col("r.full_name"), F.col("r.owner.login"), F.col("r.name")))


def filter_reason(repo: dict[str, Column], cfg: RepositoryFilter) -> Column:
    """Why a repository is refused, else "accepted"; repo: fork, archived, stars, size_kb, license (columns)."""
    none = F.lit(None).cast("string")
    unless = lambda on, test, reason: F.when(F.coalesce(test, F.lit(False)), reason).otherwise(none) if on else none
    spdx = F.nullif(repo["license"], F.lit(""))
    has_license = repo.get("has_license", spdx.isNotNull())
    return F.coalesce(
        unless(cfg.exclude_forks, repo["fork"], "fork"),
        unless(cfg.exclude_archived, repo["archived"], "archived"),
        unless(True, F.coalesce(repo["stars"], F.lit(0)) < cfg.min_stars, "stars"),
        unless(True, F.coalesce(repo["size_kb"], F.lit(0)).cast("long") * 1024 > cfg.max_size_bytes, "repository_size"),
        unless(cfg.require_license, ~has_license, "missing_license"),
        unless(cfg.require_license, ~F.coalesce(spdx.isin(*sorted(cfg.allowed_licenses)), F.lit(False)), F.concat(F.lit("license:"), F.coalesce(spdx, F.lit("unknown")))),
        F.lit("accepted"),
    )


def judge(parsed: DataFrame, cfg: RepositoryFilter) -> DataFrame:
    """Parsed hits with their reason; rows are hits, so a repository that two queries found counts twice."""
    r = F.col("r")
    columns = {"fork": r["fork"], "archived": r["archived"], "stars": r["stargazers_count"], "size_kb": r["size"], "license": r["license"]["spdx_id"], "has_license": r["license"].isNotNull()}
    return parsed.withColumn("reason", filter_reason(columns, cfg))


def merge_hits(hits: DataFrame) -> DataFrame:
    """One row for each (full_name, query_name) with the first time it was seen."""
    return hits.groupBy("full_name", "query_name").agg(F.min("first_seen_at").alias("first_seen_at"))


def unfinished(repositories: DataFrame, hits: DataFrame, statuses: tuple[str, ...] = UNFINISHED) -> DataFrame:
    """Repositories still to do, each with the set of queries that found it (empty if none did)."""
    names = hits.groupBy(F.col("full_name").alias("hit_name")).agg(F.sort_array(F.collect_set("query_name")).alias("query_names"))
    pool = repositories.filter(F.col("status").isin(*statuses)).join(names, F.col("full_name") == F.col("hit_name"), "left").drop("hit_name")
    return pool.withColumn("query_names", F.coalesce("query_names", F.expr("cast(array() as array<string>)")))


def star_bucket(stars: Column, buckets: tuple[Bucket, ...]) -> Column:
    """The first bucket whose bounds, both inclusive, hold the stars; null if none does."""
    out = F.lit(None).cast("string")
    for b in reversed(buckets):
        inside = stars >= b.min_stars
        if b.max_stars is not None:
            inside = inside & (stars <= b.max_stars)
        out = F.when(inside, b.name).otherwise(out)
    return out
