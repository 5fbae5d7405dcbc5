"""The whole build as one plan over tables: discover, select, judge files, write, remember.

Inputs are tables, so that the network is only in the sources: search hits (query_name, page, position, repo as JSON) and
files (repository, ord, file_path, size, text, and branch and commit where known).
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import paths, records
from ..operators import budget, counters, files, repositories, sampling
from ..sinks import datasets
from ..state import transitions
from ..state.snapshots import Snapshots

log = logging.getLogger("sievecraft")


@dataclass
class Run:
    """What a build gives: the tables and the counters."""

    selected: DataFrame
    files: DataFrame
    stats: dict = field(default_factory=dict)
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Gives back what the run has kept in memory and on the executors' disks; its tables are not used after it."""
        for df in self.held:
            df.unpersist()


def discover(hits: DataFrame, cfg: Config) -> DataFrame:
    """The hits with full_name, reason and the parsed repository r; counted per hit."""
    return repositories.judge(repositories.parse(hits), cfg.repository_filter)


def merge(state: dict[str, DataFrame], judged: DataFrame) -> dict[str, DataFrame]:
    """The state with the accepted hits: new candidates are added, known ones keep their status."""
    good = judged.filter("reason = 'accepted'")
    now = F.current_timestamp()
    last = F.max_by(F.struct(F.col("r.stargazers_count").alias("stars"), F.col("r.license.spdx_id").alias("license"), F.col("repo").alias("candidate_json")), F.struct("page", "position", "query_name")).alias("x")
    found = good.groupBy("full_name").agg(last).select("full_name", "x.*", now.alias("updated_at"))
    names = good.select("full_name", "query_name", now.alias("first_seen_at"))
    return state | {"repositories": transitions.upsert(state["repositories"], found), "query_hits": repositories.merge_hits(state["query_hits"].unionByName(names))}


def pool(state: dict[str, DataFrame]) -> DataFrame:
    """Unfinished candidates with stars and query_names; those whose JSON is broken are left out."""
    unfinished = repositories.unfinished(state["repositories"], state["query_hits"])
    return repositories.parse(unfinished.drop("full_name"), "candidate_json").select("full_name", F.coalesce("r.stargazers_count", F.lit(0)).alias("stars"), "query_names", "r")


def select(candidates: DataFrame, state: dict[str, DataFrame], cfg: Config) -> tuple[DataFrame, int]:
    """The repositories of this run, and how many candidates were left out as crawled before."""
    if not cfg.sampling.avoid_previously_crawled:
        return sampling.select_repositories(candidates, cfg.github.queries, cfg.sampling), 0
    crawled = state["repositories"].filter("status = 'crawled'").select("full_name")
    unseen = candidates.join(crawled, "full_name", "left_anti")
    return sampling.select_repositories(unseen, cfg.github.queries, cfg.sampling), candidates.count() - unseen.count()


def preview(hits: DataFrame, state: dict[str, DataFrame], cfg: Config) -> tuple[DataFrame, dict]:
    """What a run would select; nothing is written."""
    judged = discover(hits, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    merged = merge(state, judged)
    candidates = pool(merged)
    chosen, skipped = select(candidates, state, cfg)
    counts = judged.agg(F.count("*"), F.count_if(F.col("reason") != "accepted")).first()
    out = chosen.orderBy("place").select("full_name", "stars", F.col("r.license.spdx_id").alias("license"), F.array_join("query_names", ",").alias("queries"))
    return out, {"candidate_results": counts[0], "repositories_rejected": counts[1], "unique_candidates": candidates.count(), "repositories_skipped_previously_crawled": skipped, "repositories_selected": chosen.count()}


def judge_files(found: DataFrame, registry: DataFrame, cfg: Config, start_bytes: int = 0, held: list[DataFrame] | None = None) -> DataFrame:
    """found: repository, place, ord, file_path, size, text, r.  Every eligible file with its one outcome, and all that the
    manifest holds.  What it persists joins ``held``."""
    f = cfg.file_filter
    eligible = files.first_eligible(found.filter(paths.eligible(F.col("file_path"), f.extensions, f.ignore_directories)), cfg.runtime.max_files_per_repository)
    small = F.coalesce(F.col("size") <= f.max_file_size_bytes, F.lit(True))
    none = F.lit(None).cast("string")
    judged = files.scan_secrets(files.process(eligible.filter(small), f, cfg.quality), cfg.security)
    judged = judged.persist(StorageLevel.MEMORY_AND_DISK)  # the parser runs once
    if held is not None:
        held.append(judged)
    order = ["place", "ord"]
    clear = judged.filter(F.col("reason").isNull() & ~F.col("secret"))
    unique = files.dedup(clear, registry, order, cfg.deduplication)

    branch, login, name = F.coalesce("r.default_branch", F.lit("main")), F.col("r.owner.login"), F.col("r.name")
    commit = F.col("commit") if "commit" in found.columns else none
    unique = unique.withColumns(
        {
            "branch": branch, "tree_sha": commit, "file_sha": commit, "license": F.col("r.license.spdx_id"), "stars": F.col("r.stargazers_count"),
            "source_url": records.source_url(login, name, branch, F.col("file_path")), "split": records.split(F.col("repository"), cfg.output.split_seed, cfg.output.validation_ratio),
        }
    )
    accepted = unique.filter("duplicate is null")
    if cfg.runtime.max_output_records:
        accepted = budget.first_records(accepted, "place", order, cfg.runtime.max_output_records)
    with_meta = cfg.output.include_metadata_in_dataset
    size = records.record_bytes(F.col("code"), datasets.metadata() if with_meta else None, len(datasets.MANIFEST_FIELDS))
    accepted = budget.within_bytes(accepted, "place", order, size, cfg.output.max_dataset_size_bytes, start_bytes).withColumn("bytes", size)
    rest = [unique.filter("duplicate is not null"), judged.filter(F.col("reason").isNotNull() | F.col("secret")), eligible.filter(~small)]
    out = accepted
    for part in rest:
        out = out.unionByName(part, allowMissingColumns=True)
    over = ~F.coalesce(F.col("fits"), F.lit(True))
    return out.withColumn("outcome", files.outcome(F.col("size"), f.max_file_size_bytes, F.col("reason"), F.coalesce("secret", F.lit(False)), F.coalesce("duplicate", F.lit("")), over))


def build(spark: SparkSession, cfg: Config, hits: DataFrame, repository_files, progress: DataFrame | None = None) -> Run:
    """A run: reads the state, writes dataset, manifest and statistics, and then the next state.

    ``repository_files(selected)`` gives the files of the selected repositories (full_name, r, place): repository, ord,
    file_path, size, text.  The state is committed last, and only from what was written.
    """
    out = cfg.output
    store = Snapshots(spark, out.state_file)
    fresh = out.mode == "overwrite"
    if fresh:
        store.reset()
    state = store.read()
    state["repositories"] = transitions.recover(state["repositories"])
    start = 0 if fresh else datasets.folder_bytes(spark, out.train_file, out.validation_file)
    stats: dict = {"queries": len(cfg.github.queries), "dataset_size_bytes": start, "storage_limit_reached": False}
    if 0 < out.max_dataset_size_bytes <= start:
        log.warning("the dataset has reached its limit of %d bytes", out.max_dataset_size_bytes)
        stats["storage_limit_reached"] = True
        none = spark.createDataFrame([], "full_name string")
        return Run(none, none, stats)

    judged = discover(hits, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    counts = judged.agg(F.count("*"), F.count_if(F.col("reason") == "accepted"), F.count_if(F.col("reason") != "accepted")).first()
    stats |= dict(zip(("candidate_results", "repositories_accepted", "repositories_rejected"), counts))
    stats["repositories_found"] = stats["candidate_results"]
    state = merge(state, judged)
    candidates = pool(state)
    stats["unique_candidates"] = candidates.count()
    chosen, skipped = select(candidates, state, cfg)
    chosen = chosen.persist(StorageLevel.MEMORY_AND_DISK)
    stats |= {"repositories_skipped_previously_crawled": skipped, "repositories_selected": chosen.count()}

    found = repository_files(chosen)
    failed = spark.createDataFrame([], "full_name string, error string")
    if "error" in found.columns:  # fetched: landed once, so that dataset, manifest and state see the same commits, whatever is lost later
        found = landed(found, f"{cfg.runtime.work_dir}/landed/files")
        failed = found.filter("error is not null").select(F.col("repository").alias("full_name"), "error")
        found = found.filter("error is null").drop("error")
        if not cfg.runtime.continue_on_repository_error and (first := failed.first()) is not None:
            raise RuntimeError(f"{first['full_name']}: {first['error']}")
        found = found.join(failed.select(F.col("full_name").alias("repository")), "repository", "left_anti")
    located = found.join(chosen.select(F.col("full_name").alias("repository"), "place", "r"), "repository")
    held = [judged, chosen]
    done = judge_files(located, state["code_hashes"], cfg, start, held).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(done)
    accepted = done.filter("outcome = 'accepted'")
    mode = "overwrite" if fresh else "append"
    for split, path in (("train", out.train_file), ("validation", out.validation_file)):
        datasets.write_records(accepted.filter(F.col("split") == split), path, out.include_metadata_in_dataset, mode)
    datasets.write_manifest(accepted, out.metadata_file, mode)

    stats |= counters.file_counts(done).first().asDict() | {"files_found": located.count()}
    # a repository that the byte limit has cut off stays in processing, so that the next run takes it up again
    cut = done.filter("outcome = 'storage_limit'").select(F.col("repository").alias("full_name")).distinct()
    tables = transitions.mark(state["repositories"], chosen.select("full_name", F.lit(None).cast("string").alias("error")), "processing")
    tables = transitions.mark(tables, failed, "failed")
    tables = transitions.mark(tables, chosen.join(cut.union(failed.select("full_name")), "full_name", "left_anti").select("full_name", F.lit(None).cast("string").alias("error")), "crawled")
    state |= {"repositories": tables, "code_hashes": transitions.register(state["code_hashes"], accepted, cfg.deduplication.structural)}
    if progress is not None:
        state["query_progress"] = transitions.set_progress(state["query_progress"], progress)
    store.commit(state)
    state = store.read()
    stats["repositories_crawled"] = chosen.join(state["repositories"].filter("status = 'crawled'").select("full_name"), "full_name", "left_semi").count()
    stats["repositories_failed"] = failed.select("full_name").distinct().count()
    stats["dataset_size_bytes"] = datasets.folder_bytes(spark, out.train_file, out.validation_file)
    stats["state"] = {r["status"]: r["n"] for r in counters.status_counts(state["repositories"]).collect()} | counters.hash_counts(state["code_hashes"]).first().asDict()
    write_stats(spark, stats, f"{cfg.runtime.work_dir}/stats")
    return Run(chosen, done, stats, held)


def landed(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written to ``path`` once, in the place of an earlier run's, and read from there."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_stats(spark: SparkSession, stats: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(stats, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
