"""Files of repositories from the host itself: pinned commits, archives, trees and blobs, fetched inside the tasks.

A repository that fails gives one row with its error, so the others go on.
"""

from __future__ import annotations

import base64
import tempfile
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame

from ..config import Config
from . import archives
from .search import HttpError, request_json, wait_seconds

FETCHED = "repository string, ord int, file_path string, size long, raw binary, commit string, error string"
#: Fixed value: bytes of a download that are read at a time.
_CHUNK = 8192


@dataclass(frozen=True)
class Client:
    """Requests with the ladder of retries that ``search.request_json`` has."""

    url: str
    token: str | None = None
    api_version: str = "2022-11-28"
    timeout: float = 30.0
    retries: int = 4
    backoff: float = 2.0

    def _json(self, path: str) -> dict:
        return request_json(f"{self.url}{path}", self.token, self.api_version, self.timeout, self.retries, self.backoff)

    def commit(self, owner: str, name: str, branch: str) -> str:
        """The commit that the branch is at."""
        return self._json(f"/repos/{owner}/{name}/commits/{urllib.parse.quote(branch, safe='')}")["sha"]

    def tree(self, owner: str, name: str, ref: str, recursive: bool = True) -> dict:
        return self._json(f"/repos/{owner}/{name}/git/trees/{ref}" + "?recursive=1" * recursive)

    def files(self, owner: str, name: str, commit: str) -> list[tuple[str, dict]]:
        """(prefix, entry) of all files; where the whole listing is cut short, subtree by subtree."""
        whole = self.tree(owner, name, commit)
        return archives.walk_tree(lambda ref: whole if ref == commit and not whole.get("truncated") else self.tree(owner, name, ref, recursive=False) | ({"truncated": True} if ref == commit else {}), commit)

    def blob(self, owner: str, name: str, sha: str) -> bytes:
        found = self._json(f"/repos/{owner}/{name}/git/blobs/{sha}")
        if found.get("encoding") != "base64":
            raise ValueError(f"unsupported encoding: {found.get('encoding')}")
        return base64.b64decode(found["content"])

    def archive(self, owner: str, name: str, ref: str, kind: str = "zip") -> BinaryIO:
        """The archive, streamed to a nameless file of the task's own, which goes when it is closed."""
        url = f"{self.url}/repos/{owner}/{name}/{'zipball' if kind == 'zip' else 'tarball'}/{ref}"
        headers = {"X-GitHub-Api-Version": self.api_version, "User-Agent": "sievecraft"} | ({"Authorization": f"Bearer {self.token}"} if self.token else {})
        for attempt in range(self.retries + 1):
            out = tempfile.TemporaryFile()
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=self.timeout) as answer:
                    while chunk := answer.read(_CHUNK):
                        out.write(chunk)
                out.seek(0)
                return out
            except urllib.error.HTTPError as e:
                if e.code not in (403, 429) and e.code < 500 or attempt == self.retries:
                    raise HttpError(e.code, e.read().decode("utf-8", "replace")) from e
                time.sleep(wait_seconds(dict(e.headers or {}), attempt, self.backoff, time.time()))
            except OSError as e:
                if attempt == self.retries:
                    raise HttpError(0, str(e)) from e
                time.sleep(self.backoff * 2**attempt)
            out.close()
        raise AssertionError("unreachable")


def client(cfg: Config) -> Client:
    g = cfg.github
    return Client(g.api_base_url, g.token(), g.api_version, g.timeout_seconds, g.max_retries, g.retry_backoff_seconds)


def _files(c: Client, owner: str, name: str, commit: str, cfg: Config) -> Iterator[tuple[int, str, int, bytes | None]]:
    """ord, path, size, content; content is None for files above the limit, which are counted but not read."""
    f = cfg.file_filter
    by_path, most = archives.admitting(f.extensions, f.ignore_directories), f.max_file_size_bytes
    if cfg.github.download_method == "archive":
        with c.archive(owner, name, commit, cfg.github.archive_format) as raw:
            yield from archives.entries(raw, by_path)
        return
    for ord_, (prefix, e) in enumerate(c.files(owner, name, commit)):
        path, size = prefix + e["path"], int(e.get("size") or 0)
        if by_path(path, size):
            yield ord_, path, size, None if size > most else c.blob(owner, name, e["sha"])


def fetch_files(selected: DataFrame, cfg: Config) -> DataFrame:
    """selected: full_name, r (owner.login, name, default_branch).  ``FETCHED`` with text, for ``plans.build``."""
    c = client(cfg)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [x.split()[0] for x in FETCHED.split(", ")]
        for frame in frames:
            for full, owner, name, branch in zip(frame["full_name"], frame["login"], frame["name"], frame["branch"]):
                rows, size = [], 0
                try:
                    commit = c.commit(owner, name, branch or "main")
                    for ord_, path, n, raw in _files(c, owner, name, commit, cfg):
                        rows.append((full, ord_, path, n, raw, commit, None))
                        size += len(raw or b"")
                        if size > 32 << 20:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, size = [], 0
                except Exception as e:  # a row for the repository's state; the others go on
                    rows.append((full, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(rows, columns=columns).astype({"ord": "Int32", "size": "Int64"})

    asked = selected.selectExpr("full_name", "r.owner.login as login", "r.name as name", "r.default_branch as branch")
    # the selected are few rows, in one partition after their limit; dealt out, many are fetched at a time
    asked = asked.repartition(4 * selected.sparkSession.sparkContext.defaultParallelism, "full_name")
    return archives.decode(asked.mapInPandas(run, FETCHED)).drop("raw")
