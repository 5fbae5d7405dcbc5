"""Repository search as a Spark data source.

Each query is a partition whose pages are read one after another; the service ends a search after 1,000 results.  After
the hits of each page, also of an empty one, comes a row that says where a later run goes on.  The offline form reads a
dump of pages, with the same schema.  ``fetch`` can be replaced, for tests and other transports.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import Host
from ..schemas import SEARCH_ROW

#: Fixed value: results of one search that the service gives.
WINDOW = 1000
_AGAIN = frozenset((403, 429))


class HttpError(RuntimeError):
    def __init__(self, status: int, detail: str) -> None:
        super().__init__(f"HTTP {status}: {detail[:500]}")
        self.status, self.detail = status, detail


def wait_seconds(headers: dict[str, str], attempt: int, backoff: float, now: float) -> float:
    """How long to wait: as the service says, until its limit is reset, or doubling."""
    low = {k.lower(): v for k, v in headers.items()}
    if low.get("retry-after", "").isdigit():
        return float(low["retry-after"])
    if low.get("x-ratelimit-remaining") == "0" and low.get("x-ratelimit-reset", "").isdigit():
        return max(1.0, float(low["x-ratelimit-reset"]) - now)
    return backoff * 2**attempt


def request_json(url: str, token: str | None, api_version: str, timeout: float, retries: int, backoff: float, open_=urllib.request.urlopen, sleep=time.sleep) -> dict:
    """The JSON at ``url``; limits, server errors and broken answers are tried again, other statuses raise at once."""
    headers = {"Accept": "application/vnd.github+json", "X-GitHub-Api-Version": api_version, "User-Agent": "sievecraft"}
    if token:
        headers["Authorization"] = f"Bearer {token}"
    for attempt in range(retries + 1):
        try:
            with open_(urllib.request.Request(url, headers=headers), timeout=timeout) as answer:
                return json.loads(answer.read())
        except urllib.error.HTTPError as e:
            detail = e.read().decode("utf-8", "replace")
            if e.code not in _AGAIN and e.code < 500 or attempt == retries:
                raise HttpError(e.code, detail) from e
            sleep(wait_seconds(dict(e.headers or {}), attempt, backoff, time.time()))
        except (OSError, ValueError) as e:
            if attempt == retries:
                raise HttpError(0, str(e)) from e
            sleep(backoff * 2**attempt)
    raise AssertionError("unreachable")


@dataclass
class Progress:
    next_page: int
    exhausted: bool


def pages(fetch: Callable[[int, int], dict], page_size: int, most: int, start_page: int = 1, max_pages: int = 0) -> Iterator[tuple[int, list[dict], Progress]]:
    """page, items and the progress after it.  The page size stays the same, so that pages keep their bounds."""
    size, page, taken = min(page_size, 100), start_page, 0
    while taken < most and not (max_pages and page - start_page >= max_pages):
        if (page - 1) * size >= WINDOW:
            yield page, [], Progress(page, True)
            return
        try:
            items = fetch(page, size).get("items", [])
        except HttpError as e:
            if e.status == 422 and "1000 search results" in e.detail:
                yield page, [], Progress(page, True)
                return
            raise
        done = len(items) < size
        taken += len(items)
        kept = items[: len(items) - max(0, taken - most)]
        yield page, kept, Progress(page if done else page + 1, done)
        if done:
            return
        page += 1


@dataclass
class _QueryPartition(InputPartition):
    name: str
    query: str
    start_page: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [_QueryPartition(q["name"], q["query"], int(q.get("start_page", 1))) for q in json.loads(self.options["queries"])]

    def read(self, partition: _QueryPartition) -> Iterator[tuple]:
        o = self.options

        def fetch(page: int, size: int) -> dict:
            args = urllib.parse.urlencode({"q": partition.query, "sort": o.get("sort", "stars"), "order": o.get("order", "desc"), "per_page": size, "page": page})
            return request_json(f"{o['url']}/search/repositories?{args}", o.get("token"), o.get("api_version", "2022-11-28"), float(o.get("timeout", 30)), int(o.get("retries", 4)), float(o.get("backoff", 2)))

        for page, items, after in pages(fetch, int(o.get("page_size", 100)), int(o.get("max_repositories", 1000)), partition.start_page, int(o.get("max_pages", 0))):
            for position, item in enumerate(items):
                yield partition.name, page, position, json.dumps(item, ensure_ascii=False), None, None
            yield partition.name, page, None, None, after.next_page, after.exhausted


class SearchSource(DataSource):
    """spark.read.format("repository_search"): query_name, page, position, repo (JSON), next_page, exhausted."""

    @classmethod
    def name(cls) -> str:
        return "repository_search"

    def schema(self) -> str:
        return SEARCH_ROW

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def search(spark: SparkSession, host: Host, start_pages: dict[str, int] | None = None) -> DataFrame:
    """The rows of all queries; ``start_pages`` goes on where an earlier run ended."""
    spark.dataSource.register(SearchSource)
    listed = [{"name": q.name, "query": q.query, "start_page": (start_pages or {}).get(q.name, 1)} for q in host.queries]
    options = {
        "queries": json.dumps(listed), "url": host.api_base_url, "api_version": host.api_version, "sort": host.sort, "order": host.order, "page_size": host.page_size,
        "max_repositories": host.max_repositories, "max_pages": host.max_pages_per_query, "timeout": host.timeout_seconds, "retries": host.max_retries, "backoff": host.retry_backoff_seconds,
    }
    if token := host.token():
        options["token"] = token
    return spark.read.format("repository_search").options(**{k: str(v) for k, v in options.items()}).load()


def hits(rows: DataFrame) -> DataFrame:
    """The hits among the rows of a search."""
    return rows.filter("position is not null").select("query_name", "page", "position", "repo")


def progress(rows: DataFrame, host: Host) -> DataFrame:
    """The rows of query_progress after a search: what its reader said after the last page of each query."""
    texts = rows.sparkSession.createDataFrame([(q.name, q.query) for q in host.queries], "name string, query_text string")
    last = rows.filter("next_page is not null").groupBy("query_name").agg(F.max(F.struct("page", "next_page", "exhausted")).alias("x"))
    return last.join(texts, F.col("query_name") == F.col("name")).select("query_name", "query_text", "x.next_page", "x.exhausted", F.current_timestamp().alias("updated_at"))


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """The same from JSON lines written earlier."""
    return spark.read.schema(SEARCH_ROW).json(path)
