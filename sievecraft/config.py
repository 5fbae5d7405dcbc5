"""The configuration: frozen dataclasses, read from YAML or a mapping, checked as a whole on the driver."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any


class ConfigError(ValueError):
    """The configuration is unusable; the message says which key."""


@dataclass(frozen=True)
class Query:
    name: str
    query: str
    weight: float = 1.0


@dataclass(frozen=True)
class Bucket:
    name: str
    min_stars: int
    max_stars: int | None
    weight: float


@dataclass(frozen=True)
class Host:
    token_env: str
    api_base_url: str
    api_version: str
    queries: tuple[Query, ...]
    download_method: str = "archive"
    archive_format: str = "zip"
    sort: str = "stars"
    order: str = "desc"
    max_repositories: int = 1000
    page_size: int = 100
    timeout_seconds: float = 30.0
    max_retries: int = 4
    retry_backoff_seconds: float = 2.0
    max_pages_per_query: int = 10

    def token(self) -> str | None:
        """From the environment variable that the configuration names; None means requests without authentication."""
        return os.environ.get(self.token_env)


@dataclass(frozen=True)
class RepositoryFilter:
    min_stars: int
    max_size_bytes: int
    allowed_licenses: frozenset[str]
    require_license: bool = True
    exclude_archived: bool = True
    exclude_forks: bool = True


@dataclass(frozen=True)
class FileFilter:
    extensions: tuple[str, ...]
    max_file_size_bytes: int
    min_code_characters: int
    max_code_characters: int
    min_code_lines: int
    min_tokens: int
    ignore_directories: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Quality:
    generated_markers: tuple[str, ...]
    max_repeated_line_ratio: float
    syntax_check: bool = True
    reject_generated_code: bool = True
    reject_binary: bool = True


@dataclass(frozen=True)
class Security:
    enabled: bool = True
    reject_on_detection: bool = True


@dataclass(frozen=True)
class Dedup:
    exact: bool = True
    structural: bool = False


#: The star bands that hold where the configuration has none.
DEFAULT_BUCKETS = (
    Bucket("very_high", 10000, None, 0.10),
    Bucket("high", 2000, 9999, 0.25),
    Bucket("medium", 500, 1999, 0.35),
    Bucket("low", 100, 499, 0.30),
)


@dataclass(frozen=True)
class Sampling:
    strategy: str = "stratified"
    repositories_per_run: int = 100
    candidate_pool_size: int = 1000
    seed: int = 42
    avoid_previously_crawled: bool = True
    star_buckets: tuple[Bucket, ...] = DEFAULT_BUCKETS


@dataclass(frozen=True)
class Output:
    train_file: str
    validation_file: str
    metadata_file: str
    validation_ratio: float
    split_seed: int
    mode: str = "append"
    include_metadata_in_dataset: bool = False
    state_file: str = "run/state"
    max_dataset_size_bytes: int = 0


@dataclass(frozen=True)
class Runtime:
    work_dir: str
    log_level: str = "INFO"
    continue_on_repository_error: bool = True
    max_files_per_repository: int = 0
    max_output_records: int = 0


@dataclass(frozen=True)
class Config:
    github: Host
    repository_filter: RepositoryFilter
    file_filter: FileFilter
    quality: Quality
    security: Security
    deduplication: Dedup
    sampling: Sampling
    output: Output
    runtime: Runtime


_MISSING = object()


class _Section:
    """A section's mapping; each getter checks its key's value."""

    def __init__(self, raw: Mapping[str, Any], name: str) -> None:
        values = raw.get(name, _MISSING)
        if not isinstance(values, Mapping):
            raise ConfigError(f"section {name} is missing")
        self.values, self.name = values, name

    def get(self, key: str, default: Any = _MISSING) -> Any:
        value = self.values.get(key, default)
        if value is _MISSING:
            raise ConfigError(f"{self.name}.{key} is missing")
        return value

    def whole(self, key: str, default: Any = _MISSING, least: int | None = 0) -> int:
        value = int(self.get(key, default))
        if least is not None and value < least:
            raise ConfigError(f"{self.name}.{key} must be at least {least}")
        return value

    def one_of(self, key: str, default: str, options: tuple[str, ...]) -> str:
        value = str(self.get(key, default)).lower()
        if value not in options:
            raise ConfigError(f"{self.name}.{key} must be one of {', '.join(options)}")
        return value

    def flag(self, key: str, default: bool) -> bool:
        return bool(self.get(key, default))


def _queries(section: _Section) -> tuple[Query, ...]:
    listed = section.get("queries", None)
    if listed is None:
        return (Query("default", str(section.get("query"))),)
    found = []
    for i, item in enumerate(listed, 1):
        if isinstance(item, str):
            item = {"query": item}
        if not isinstance(item, Mapping):
            raise ConfigError("github.queries must hold strings or mappings")
        entry = _Section({"q": item}, "q")
        found.append(Query(str(entry.get("name", f"query_{i}")), str(entry.get("query")), float(entry.get("weight", 1.0))))
    if any(q.weight < 0 for q in found) or not any(q.weight > 0 for q in found):
        raise ConfigError("github.queries needs weights of at least 0 and one above")
    if len({q.name for q in found}) < len(found):
        raise ConfigError("github.queries has a name twice")
    return tuple(found)


def _buckets(listed: Any) -> tuple[Bucket, ...]:
    found = list(DEFAULT_BUCKETS)
    if listed is not None:
        found = []
        for item in listed:
            entry = _Section({"sampling.star_buckets": item}, "sampling.star_buckets")
            top = item.get("max_stars")
            found.append(Bucket(str(entry.get("name")), entry.whole("min_stars"), None if top is None else int(top), float(entry.get("weight"))))
    total = sum(b.weight for b in found)
    if any(b.weight < 0 for b in found) or total <= 0:
        raise ConfigError("sampling.star_buckets needs weights of at least 0 and one above")
    if len({b.name for b in found}) < len(found):
        raise ConfigError("sampling.star_buckets has a name twice")
    if any(b.max_stars is not None and b.max_stars < max(b.min_stars, 0) for b in found):
        raise ConfigError("sampling.star_buckets has max_stars below min_stars")
    return tuple(Bucket(b.name, b.min_stars, b.max_stars, b.weight / total) for b in found)


def from_mapping(raw: Mapping[str, Any]) -> Config:
    gh, rf, ff, q = (_Section(raw, x) for x in ("github", "repository_filter", "file_filter", "quality"))
    sec, dd, sa, out, rt = (_Section(raw, x) for x in ("security", "deduplication", "sampling", "output", "runtime"))

    extensions = tuple(str(x).lower() for x in ff.get("extensions"))
    if not extensions:
        raise ConfigError("file_filter.extensions is empty")
    licenses = frozenset(map(str, rf.get("allowed_licenses")))
    if rf.flag("require_license", True) and not licenses:
        raise ConfigError("repository_filter.allowed_licenses is empty, and a license is required")
    validation, repeated = float(out.get("validation_ratio")), float(q.get("max_repeated_line_ratio"))
    if not 0 <= validation < 1:
        raise ConfigError("output.validation_ratio must be at least 0 and below 1")
    if not 0 <= repeated <= 1:
        raise ConfigError("quality.max_repeated_line_ratio must be from 0 to 1")
    return Config(
        Host(
            str(gh.get("token_env")), str(gh.get("api_base_url")).rstrip("/"), str(gh.get("api_version")), _queries(gh), str(gh.get("download_method", "archive")), str(gh.get("archive_format", "zip")), str(gh.get("sort", "stars")), str(gh.get("order", "desc")),
            gh.whole("max_repositories", 1000), min(100, gh.whole("page_size", 100, 1)), float(gh.get("timeout_seconds", 30)), gh.whole("max_retries", 4), float(gh.get("retry_backoff_seconds", 2)), gh.whole("max_pages_per_query", 10),
        ),
        RepositoryFilter(rf.whole("min_stars", least=None), rf.whole("max_size_bytes", least=1), licenses, rf.flag("require_license", True), rf.flag("exclude_archived", True), rf.flag("exclude_forks", True)),
        FileFilter(
            extensions, ff.whole("max_file_size_bytes", least=1), ff.whole("min_code_characters", least=None), ff.whole("max_code_characters", least=None), ff.whole("min_code_lines", least=None), ff.whole("min_tokens", least=None),
            frozenset(str(x).strip("/").lower() for x in ff.get("ignore_directories")),
        ),
        Quality(tuple(str(x).lower() for x in q.get("generated_markers")), repeated, q.flag("syntax_check", True), q.flag("reject_generated_code", True), q.flag("reject_binary", True)),
        Security(sec.flag("enabled", True), sec.flag("reject_on_detection", True)),
        Dedup(dd.flag("exact", True), dd.flag("structural", False)),
        Sampling(sa.one_of("strategy", "stratified", ("top", "random", "stratified")), sa.whole("repositories_per_run", 100, 1), sa.whole("candidate_pool_size", 1000), sa.whole("seed", 42, None), sa.flag("avoid_previously_crawled", True), _buckets(sa.get("star_buckets", None))),
        Output(
            str(out.get("train_file")), str(out.get("validation_file")), str(out.get("metadata_file")), validation, out.whole("split_seed", least=None), out.one_of("mode", "append", ("append", "overwrite")),
            out.flag("include_metadata_in_dataset", False), str(out.get("state_file", "run/state")), out.whole("max_dataset_size_bytes", 0),
        ),
        Runtime(str(rt.get("work_dir")), str(rt.get("log_level", "INFO")).upper(), rt.flag("continue_on_repository_error", True), rt.whole("max_files_per_repository", 0), rt.whole("max_output_records", 0)),
    )


def load_config(path: str) -> Config:
    """From a YAML file (or JSON, which needs no further library)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if str(path).endswith(".json"):
        import json

        return from_mapping(json.loads(text))
    import yaml

    return from_mapping(yaml.safe_load(text) or {})
