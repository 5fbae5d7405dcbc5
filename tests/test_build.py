"""Configuration, sources, and whole runs."""

import io
import json
import tarfile
import zipfile
from dataclasses import replace

import pytest

from sievecraft import config
from sievecraft.plans import build as plans
from sievecraft.plans import cli
from sievecraft.sources import archives, jsonl, search
from sievecraft.sinks import datasets
from sievecraft.state.snapshots import Snapshots
from sievecraft.streaming import incremental


def raw(tmp, **changes):
    out = {
        "github": {"token_env": "NO_SUCH_TOKEN", "api_base_url": "https://host/", "api_version": "1", "queries": [{"name": "q1", "query": "a", "weight": 0.5}, "b"]},
        "repository_filter": {"min_stars": 1, "max_size_bytes": 10**9, "allowed_licenses": ["MIT"]},
        "file_filter": {"extensions": [".PY"], "max_file_size_bytes": 1000, "min_code_characters": 10, "max_code_characters": 5000, "min_code_lines": 1, "min_tokens": 3, "ignore_directories": ["/Build/"]},
        "quality": {"generated_markers": ["DO NOT EDIT"], "max_repeated_line_ratio": 0.8},
        "security": {}, "deduplication": {"structural": True}, "sampling": {"repositories_per_run": 10, "strategy": "top"},
        "output": {"train_file": f"file://{tmp}/train", "validation_file": f"file://{tmp}/validation", "metadata_file": f"file://{tmp}/manifest", "validation_ratio": 0.1, "split_seed": 42, "state_file": f"file://{tmp}/state"},
        "runtime": {"work_dir": f"file://{tmp}/work"},
    }
    for key, value in changes.items():
        section, _, name = key.partition("__")
        out[section] = out[section] | {name: value}
    return out


def test_config(tmp_path):
    cfg = config.from_mapping(raw(tmp_path))
    assert cfg.github.queries[1] == config.Query("query_2", "b", 1.0) and cfg.github.api_base_url == "https://host" and cfg.github.page_size == 100
    assert cfg.file_filter.extensions == (".py",) and cfg.file_filter.ignore_directories == {"build"} and cfg.quality.generated_markers == ("do not edit",)
    assert sum(b.weight for b in cfg.sampling.star_buckets) == pytest.approx(1.0)
    path = tmp_path / "c.yaml"
    path.write_text(json.dumps(raw(tmp_path)))  # JSON is YAML
    assert config.load_config(str(path)) == cfg


@pytest.mark.parametrize(
    "key, value",
    [
        ("file_filter__extensions", []), ("repository_filter__allowed_licenses", []), ("output__validation_ratio", 1.0), ("quality__max_repeated_line_ratio", 1.5), ("output__mode", "other"), ("sampling__strategy", "best"), ("sampling__repositories_per_run", 0),
        ("repository_filter__max_size_bytes", 0), ("github__queries", [{"query": "a", "weight": -1}]), ("github__queries", [{"query": "a", "weight": 0}]), ("github__queries", [{"query": "a", "name": "x"}, {"query": "b", "name": "x"}]),
        ("sampling__star_buckets", [{"name": "a", "min_stars": 5, "max_stars": 4, "weight": 1}]), ("sampling__star_buckets", [{"name": "a", "min_stars": 5, "weight": 0}]), ("sampling__star_buckets", [{"name": "a", "min_stars": 1, "weight": 1}] * 2),
    ],
)
def test_bad_config(tmp_path, key, value):
    with pytest.raises(ValueError):
        config.from_mapping(raw(tmp_path, **{key: value}))


def test_missing_section(tmp_path):
    whole = raw(tmp_path)
    del whole["quality"]
    with pytest.raises(config.ConfigError, match="quality"):
        config.from_mapping(whole)


ENTRIES = {"root/src/a.py": b"x = 1\n", "root/Build/b.py": b"no", "root/src/c.txt": b"no", "top.py": b"no root", "root/bad.py": b"a\xffb", "root/big.py": b"#" * 5000}


def _zip():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("root/", b"")
        for name, data in ENTRIES.items():
            z.writestr(name, data)
    return out.getvalue()


def _tar(mode):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        link = tarfile.TarInfo("root/link.py")
        link.type, link.linkname = tarfile.SYMTYPE, "src/a.py"
        t.addfile(link)
        for name, data in ENTRIES.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


@pytest.mark.parametrize("name, data", [("o__n.zip", _zip()), ("o__n.tar.gz", _tar("w:gz")), ("o__n.tar", _tar("w"))])
def test_archives(spark, tmp_path, name, data):
    (tmp_path / name).write_bytes(data)
    found = archives.read_archives(spark, str(tmp_path), archives.admitting((".py",), frozenset({"build"}), 1000))
    rows = archives.decode(found).orderBy("ord").collect()
    assert [(r.file_path, r.text, r.size) for r in rows] == [("src/a.py", "x = 1\n", 6), ("bad.py", "a�b", 3)]


def test_blobs_and_trees(spark):
    rows = archives.decode_blobs(spark.createDataFrame([("base64", "aMOp\nbGxv"), ("utf-8", "x"), (None, None)], "encoding string, content string")).collect()
    assert [(r.text, bool(r.error)) for r in rows] == [("héllo", False), (None, True), (None, True)]
    trees = spark.createDataFrame([("r", "lib", [("a.py", "blob", "s", 3), ("d", "tree", "t", None)])], "repository string, prefix string, tree array<struct<path:string,type:string,sha:string,size:long>>")
    assert [(r.file_path, r.size) for r in archives.explode_tree(trees).collect()] == [("lib/a.py", 3)]
    store = {"root": {"truncated": True, "tree": [{"path": "lib", "type": "tree", "sha": "l"}, {"path": "x.py", "type": "blob"}]}, "l": {"tree": [{"path": "sub", "type": "tree", "sha": "s"}, {"path": "y.py", "type": "blob"}]}, "s": {"tree": [{"path": "z.py", "type": "blob"}]}}
    assert sorted(p + e["path"] for p, e in archives.walk_tree(store.__getitem__, "root")) == ["lib/sub/z.py", "lib/y.py", "x.py"]


def test_pages():
    store = [{"id": i} for i in range(1500)]
    fetch = lambda page, size: {"items": store[(page - 1) * size : page * size]}
    got = list(search.pages(fetch, 100, 5000))
    assert sum(len(i) for _, i, _ in got) == 1000 and got[-1][2] == search.Progress(11, True)
    got = list(search.pages(fetch, 100, 250))
    assert [len(i) for _, i, _ in got] == [100, 100, 50] and not got[-1][2].exhausted
    got = list(search.pages(fetch, 100, 5000, start_page=3, max_pages=2))
    assert [p for p, _, _ in got] == [3, 4] and got[-1][2] == search.Progress(5, False)
    short = list(search.pages(lambda p, s: {"items": store[:30] if p == 1 else []}, 100, 5000))
    assert len(short) == 1 and short[0][2] == search.Progress(1, True)

    def ended(page, size):
        raise search.HttpError(422, "Only the first 1000 search results are available")

    assert list(search.pages(ended, 100, 10)) == [(1, [], search.Progress(1, True))]


def test_request_retries():
    import urllib.error

    calls, waits = [], []

    class Answer(io.BytesIO):
        pass

    def open_(request, timeout):
        calls.append(request)
        if len(calls) == 1:
            raise urllib.error.HTTPError("u", 429, "slow", {"Retry-After": "7"}, io.BytesIO(b""))
        if len(calls) == 2:
            raise OSError("reset")
        return Answer(b'{"ok": 1}')

    assert search.request_json("http://x", "t", "1", 1, 3, 2.0, open_, waits.append) == {"ok": 1}
    assert waits == [7.0, 4.0] and calls[0].get_header("Authorization") == "Bearer t"

    def missing(request, timeout):
        raise urllib.error.HTTPError("u", 404, "no", {}, io.BytesIO(b"gone"))

    with pytest.raises(search.HttpError, match="404"):
        search.request_json("http://x", None, "1", 1, 3, 2.0, missing, waits.append)
    assert search.wait_seconds({"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "130"}, 0, 3, 100.0) == 30.0
    assert search.wait_seconds({}, 2, 3, 0.0) == 12


def test_search_source(spark):
    """Against a server of this machine, through Spark's reader."""
    import http.server
    import threading
    from urllib.parse import parse_qs, urlparse

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            page, size = int(q["page"]), int(q["per_page"])
            body = json.dumps({"items": [{"full_name": f"{q['q']}/{i}"} for i in range(25)][(page - 1) * size : page * size]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        host = config.Host("NO_SUCH_TOKEN", f"http://127.0.0.1:{server.server_port}", "1", (config.Query("one", "a"), config.Query("two", "b")), page_size=10)
        found = search.search(spark, host, {"two": 3})
        rows, after = search.hits(found).collect(), {r.query_name: (r.query_text, r.next_page, r.exhausted) for r in search.progress(found, host).collect()}
        cut = replace(host, max_repositories=15)
        limited = {r.query_name: (r.next_page, r.exhausted) for r in search.progress(search.search(spark, cut), cut).collect()}
        last = {r.query_name: (r.next_page, r.exhausted) for r in search.progress(search.search(spark, host, {"one": 4, "two": 2}), host).collect()}
    finally:
        server.shutdown()
    assert after == {"one": ("a", 3, True), "two": ("b", 3, True)}
    assert limited == {"one": (3, False), "two": (3, False)}  # the limit ends the run, not the search
    assert last == {"one": (4, True), "two": (3, True)}  # an empty last page says so
    assert sum(r.query_name == "one" for r in rows) == 25 and sum(r.query_name == "two" for r in rows) == 5
    assert {json.loads(r.repo)["full_name"] for r in rows if r.query_name == "two"} == {f"b/{i}" for i in range(20, 25)}


def _hit(name, query, stars, **more):
    owner, short = name.split("/")
    return (query, 1, stars, json.dumps({"full_name": name, "name": short, "owner": {"login": owner}, "default_branch": "main", "stargazers_count": stars, "size": 1, "fork": False, "archived": False, "license": {"spdx_id": "MIT"}} | more))


def _world(spark):
    hits = spark.createDataFrame([_hit("o/a", "q1", 90), _hit("o/a", "query_2", 90), _hit("o/b", "q1", 50), _hit("o/f", "q1", 70, fork=True)], "query_name string, page long, position long, repo string")
    code = "def f{0}(a):\n    return a + {0}\n"
    rows = [
        ("o/a", 0, "x.py", code.format(1)), ("o/a", 1, "y.py", code.format(1)), ("o/a", 2, "z.py", code.format(2)), ("o/a", 3, "build/w.py", "import os\nprint(os.name)\n"), ("o/a", 4, "bad.py", "def (:\n  pass pass\n"),
        ("o/b", 0, "p.py", "import sys\nprint(sys.argv, 1)\n"), ("o/b", 1, "k.py", "password = 'letmein'\nuser = 1\n"), ("o/b", 2, "big.py", "x = 1\n" * 400), ("o/b", 3, "readme.txt", "hello there, reader\n"), ("o/f", 0, "q.py", code.format(7)),
    ]
    files = spark.createDataFrame([(r, o, p, len(t), t) for r, o, p, t in rows], "repository string, ord int, file_path string, size long, text string")
    return hits, lambda selected: files


def test_build(spark, tmp_path):
    hits, files = _world(spark)
    cfg = config.from_mapping(raw(tmp_path))
    out, counts = plans.preview(hits, Snapshots(spark, cfg.output.state_file).read(), cfg)
    assert [r.full_name for r in out.collect()] == ["o/a", "o/b"] and counts["repositories_rejected"] == 1 and counts["candidate_results"] == 4
    run = plans.build(spark, cfg, hits, files)
    got = {(r.repository, r.file_path): r.outcome for r in run.files.collect()}
    assert got == {
        ("o/a", "x.py"): "accepted", ("o/a", "y.py"): "rejected_exact_duplicate", ("o/a", "z.py"): "rejected_structural_duplicate", ("o/a", "bad.py"): "rejected_quality",
        ("o/b", "p.py"): "accepted", ("o/b", "k.py"): "rejected_security", ("o/b", "big.py"): "skipped_large_file",
    }
    s = run.stats
    assert (s["repositories_accepted"], s["repositories_rejected"], s["unique_candidates"], s["repositories_selected"], s["repositories_crawled"]) == (3, 1, 2, 2, 2)
    assert (s["files_accepted"], s["rejected_quality"], s["rejected_security"], s["rejected_exact_duplicate"], s["rejected_structural_duplicate"], s["skipped_large_file"]) == (2, 1, 1, 1, 1, 1)
    assert s["state"] == {"crawled": 2, "exact": 2, "structural": 2} and s["dataset_size_bytes"] > 0
    texts = [r.text for r in jsonl.read_records(spark, cfg.output.train_file).union(jsonl.read_records(spark, cfg.output.validation_file)).collect()]
    assert len(texts) == 2 and any("def f1" in t for t in texts)
    manifest = spark.read.json(cfg.output.metadata_file).collect()
    assert {m.source_url for m in manifest} == {"https://github.com/o/a/blob/main/x.py", "https://github.com/o/b/blob/main/p.py"}
    assert all(m.characters > 0 and m.tokens > 0 and m.license == "MIT" and m.split in ("train", "validation") for m in manifest)

    # the next run knows what was crawled, and a new repository's copies of old files
    more = spark.createDataFrame([_hit("o/c", "q1", 10)], "query_name string, page long, position long, repo string")
    again = spark.createDataFrame([("o/c", 0, "x.py", 40, "def f1(a):\n    return a + 1\n"), ("o/c", 1, "n.py", 40, "while True:\n    print(3, 4)\n")], "repository string, ord int, file_path string, size long, text string")
    second = plans.build(spark, cfg, hits.union(more), lambda selected: again)
    assert {r.full_name for r in second.selected.collect()} == {"o/c"}
    assert {r.file_path: r.outcome for r in second.files.collect()} == {"x.py": "rejected_exact_duplicate", "n.py": "accepted"}
    assert second.stats["repositories_crawled"] == 1 and second.stats["state"]["crawled"] == 3


class Host:
    """A host of this machine: searches, commits, archives, trees and blobs."""

    def __init__(self):
        import base64
        import http.server
        import threading
        from urllib.parse import parse_qs, urlparse

        code = {"o/a": b"def f1(a):\n    return a + 1\n", "o/b": b"import sys\nprint(sys.argv, 1)\n"}
        repos = [json.loads(_hit(n, "q", s)[3]) for n, s in (("o/a", 90), ("o/b", 50), ("o/gone", 20))]

        def packed(name):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                z.writestr("root/src/x.py", code[name])
                z.writestr("root/build/y.py", b"no")
            return out.getvalue()

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                url = urlparse(self.path)
                part, page = url.path.strip("/").split("/"), int(parse_qs(url.query).get("page", ["1"])[0])
                name = "/".join(part[1:3])
                if part[0] == "search":
                    body = json.dumps({"items": repos if page == 1 else []}).encode()
                elif name not in code:
                    return self.send_error(404)
                elif part[3] == "commits":
                    body = json.dumps({"sha": f"sha-{part[4]}"}).encode()
                elif part[3] == "zipball":
                    body = packed(name)
                elif part[4] == "trees":
                    body = json.dumps({"tree": [{"path": "src/x.py", "type": "blob", "sha": "b1", "size": len(code[name])}, {"path": "big.py", "type": "blob", "sha": "b2", "size": 10**6}, {"path": "src", "type": "tree", "sha": "t"}]}).encode()
                else:
                    body = json.dumps({"encoding": "base64", "content": base64.b64encode(code[name]).decode()}).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"


@pytest.mark.parametrize("method", ["archive", "blob"])
def test_build_from_a_host(spark, tmp_path, method, capsys):
    host = Host()
    try:
        settings = raw(tmp_path, github__api_base_url=host.url, github__queries=["a"], github__max_retries=0, github__download_method=method)
        path = tmp_path / "c.json"
        path.write_text(json.dumps(settings))
        assert cli.main(["-c", str(path), "--preview"]) == 0
        assert cli.main(["-c", str(path)]) == 0
    finally:
        host.server.shutdown()
    cfg = config.from_mapping(settings)
    state = Snapshots(spark, cfg.output.state_file).read()
    assert {r.full_name: r.status for r in state["repositories"].collect()} == {"o/a": "crawled", "o/b": "crawled", "o/gone": "failed"}
    assert "404" in state["repositories"].filter("status = 'failed'").first().last_error
    assert [(r.query_name, r.next_page, r.exhausted) for r in state["query_progress"].collect()] == [("query_1", 1, True)]
    manifest = spark.read.json(cfg.output.metadata_file).collect()
    assert {(m.repository, m.file_path, m.tree_sha) for m in manifest} == {("o/a", "src/x.py", "sha-main"), ("o/b", "src/x.py", "sha-main")}
    stats = json.loads(spark.read.text(f"{cfg.runtime.work_dir}/stats").first()[0])
    assert (tmp_path / "work" / "sievecraft.log").exists()
    assert stats["repositories_failed"] == 1 and stats["files_accepted"] == 2 and stats["skipped_large_file"] == (method == "blob") * 2


def test_a_lost_task_does_not_fetch_again(spark, tmp_path):
    """The commit that a branch is at moves while the run goes on; dataset, manifest and state keep the first."""
    hits, _ = _world(spark)
    cfg = config.from_mapping(raw(tmp_path))
    calls = tmp_path / "calls"
    calls.mkdir()

    def fetched(selected):
        def run(frames):
            import pandas as pd

            for frame in frames:
                for name in frame["full_name"]:
                    n = len(list(calls.iterdir()))
                    (calls / f"{name.replace('/', '_')}-{n}").touch()
                    yield pd.DataFrame([(name, 0, "a.py", 30, f"import os\nprint(os.name, {n})\n", f"commit-{n}", None)], columns=["repository", "ord", "file_path", "size", "text", "commit", "error"])

        return selected.select("full_name").coalesce(1).mapInPandas(run, "repository string, ord int, file_path string, size long, text string, commit string, error string")

    run = plans.build(spark, cfg, hits, fetched)
    run.files.unpersist()  # as when an executor's blocks are lost
    for df in run.held:
        df.unpersist()
    again = {(r.repository, r.tree_sha) for r in run.files.filter("outcome = 'accepted'").collect()}
    assert len(list(calls.iterdir())) == 2 and {(m.repository, m.tree_sha) for m in spark.read.json(cfg.output.metadata_file).collect()} >= again


def test_budget_stops_the_run(spark, tmp_path):
    hits, files = _world(spark)
    cfg = config.from_mapping(raw(tmp_path, output__max_dataset_size_bytes=60, output__include_metadata_in_dataset=False))
    run = plans.build(spark, cfg, hits, files)
    assert {r.file_path: r.outcome for r in run.files.filter("outcome in ('accepted', 'storage_limit')").collect()} == {"x.py": "accepted", "p.py": "storage_limit"}
    assert run.stats["storage_limit_reached"] and run.stats["state"]["processing"] == 1 and run.stats["state"]["exact"] == 1


def test_text_export(spark, tmp_path):
    datasets.write_text_export(spark.createDataFrame([("a\nb",), ("",), ("c",)], "text string").coalesce(1), f"file://{tmp_path}/t")
    written = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*")))
    assert written == "a\nb\n<|file_end|>\n\nc\n<|file_end|>\n\n"
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.jsonl").write_text('{"text": "a"}\n\n{broken\n{"text": ""}\n{"other": 1}\n')
    assert [r.text for r in jsonl.read_records(spark, f"file://{tmp_path}/d").collect()] == ["a"]
    assert datasets.folder_bytes(spark, f"file://{tmp_path}/d", f"file://{tmp_path}/none") == (tmp_path / "d" / "x.jsonl").stat().st_size


def test_stream_goes_on(spark, tmp_path):
    cfg = config.from_mapping(raw(tmp_path))
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    code = "def f{0}(a):\n    return a + {0}\n"

    def land(rows):
        spark.createDataFrame(rows, incremental.FILES).coalesce(1).write.mode("append").parquet(source)
        incremental.run(spark, source, out, cfg.file_filter, cfg.quality, config.Dedup(True, True)).awaitTermination()
        return sorted(r.file_path for r in spark.read.parquet(f"{out}/accepted").collect())

    assert land([("r", 0, "a.py", code.format(1)), ("r", 1, "b.py", code.format(1)), ("r", 2, "c.py", "x")]) == ["a.py"]
    assert land([("r", 3, "d.py", code.format(1)), ("r", 4, "e.py", "import os\nprint(os.name)\n"), ("r", 5, "f.py", code.format(9))]) == ["a.py", "e.py"]


def test_cli(tmp_path, capsys):
    path = tmp_path / "c.json"
    path.write_text(json.dumps(raw(tmp_path)))
    assert cli.main(["-c", str(path), "--dry-run"]) == 0
    assert cli.main(["-c", str(tmp_path / "none.json"), "--dry-run"]) == 2
