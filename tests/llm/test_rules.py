"""Quality rules, line deduplication, secret scans and URL filters against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sievecraft.llm import lines, quality, secrets, urls

WORD = r"[^\x20\x09-\x0D]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- quality


def base_counts(text):
    text = text or ""
    w = re.findall(WORD + "+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {p for i, x in enumerate(windows) if n[x] > 1 for p in (i, i + 1, i + 2)}
    full = [x for x in text.split("\n") if re.search(WORD, x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(covered), failed


def test_quality_counts(spark, docs, clashing, empty, rows):
    expected = Counter((d, *base_counts(t)) for d, t in rows)
    for frame in (docs, clashing):
        got = quality.query(frame).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == expected
        assert not any(r.kept and r.base_failed for r in got)
    assert quality.query(empty).count() == 0


@pytest.mark.parametrize("text", ["a b c a b c a b c", "a b a b a b", "x x x", "x x x x", "a b c d a b c", "a b c\x01 a b c a b", "é è é è é è é"])
def test_windows(spark, text):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.query(frame).first().n_repeat_words == base_counts(text)[4]


def test_lines_fail_by_rule(spark):
    cases = [("%%% one ### two", True), ("one two three.", False), ("a | b | c | d", True), ("This | is a line with two | bars and a number of further words.", False), ("Buy!! now!! it!!", True), ("Really?! That is what he said to all of them then.", False), ("We use cookies. See our Privacy Policy.", True), ("Skip to content", True), ("5 < 6", True), ("", False)]
    for line, fails in cases:
        got = quality.clean_lines(spark.createDataFrame([(1, f"first line\n{line}\nlast line")], "doc_id long, text string")).first()
        assert got.quality_text == ("first line\nlast line" if fails else f"first line\n{line}\nlast line"), line
        assert got.quality_lines_failed == int(fails) and got.quality_lost_chars == (sum(len(w) for w in line.split()) if fails else 0)


def test_quality_stage(docs, clashing, rows):
    kept = {r.doc_id: r.kept for r in quality.query(docs).collect()}
    for frame in (docs, clashing):
        out = quality.stage(frame)
        got = out.collect()
        assert out.columns == frame.columns and Counter(r.doc_id for r in got) == Counter(d for d, t in rows if kept[d])
        assert all(r.n_chars is None or r.n_chars == len(r.text) for r in got if r.doc_id and r.doc_id >= 0)
    assert all(r.quality_text == "own quality_text" for r in quality.stage(clashing).collect())
    assert not any("HEY!!" in (r.text or "") for r in quality.stage(docs).collect())


# --- lines


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def line_key(line):
    return low(line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows):
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(k := line_key(line)) >= 20:
                holders[k].add(d)
    keeper = {k: max(x for x in v if x is not None) for k, v in holders.items() if len(v) >= 3}
    out = Counter()
    for d, t in rows:
        all_ = (t or "").split("\n")
        stay = [x for x in all_ if (k := line_key(x)) not in keeper or d == keeper[k]]
        out[d, len(all_), len(all_) - len(stay), sha("\n".join(stay))] += 1
    return out


def dropped(docs, index):
    return Counter((r.doc_id, r.lines_n, r.lines_dropped, sha(r.lines_text)) for r in lines.drop_lines(docs, index).collect())


def test_lines(docs, clashing, empty, rows):
    expected = brute_lines(rows)
    assert sum(n for _, _, n, _ in expected) > 10
    for frame in (docs, clashing):
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.query(frame).collect()) == expected
    assert lines.query(empty).count() == 0 and lines.stage(empty).count() == 0
    out = lines.stage(clashing)
    assert out.columns == clashing.columns and all(r.gone == "own gone" for r in out.collect())


def test_insertions_and_deletions_are_reversible(docs, rows):
    even, odd = docs.filter("doc_id is null or doc_id % 2 = 0"), docs.filter("doc_id % 2 <> 0")
    first = lines.LineIndex.of(even, n_shards=3)
    both = first.insert(odd)
    assert dropped(docs, both) == brute_lines(rows)
    again = both.delete(odd.select("doc_id"))
    assert dropped(even, again) == dropped(even, first) == brute_lines([(d, t) for d, t in rows if d is None or d % 2 == 0])
    assert dropped(even, both.delete(odd)) == dropped(even, first)
    gone = docs.filter("doc_id % 3 = 0")
    fewer = both.delete(gone.select("doc_id"))
    assert dropped(docs.filter("doc_id is null or doc_id % 3 <> 0"), fewer) == brute_lines([(d, t) for d, t in rows if d is None or d % 3])
    held = {r.shard: lines.CuckooFilter.from_bytes(r.filter) for r in fewer.table("filters").collect()}
    keys = [bytes(r.key) for r in fewer.shared().collect()]
    assert keys and all(held[int.from_bytes(k[14:], "big") % fewer.n_shards].has(k) for k in keys)


def test_a_change_touches_its_shards_only(spark, docs):
    index = lines.LineIndex.of(docs, n_shards=500)
    (version,) = index.held
    one = spark.createDataFrame([(10**6, "A line of its own, quite long.\nThis line stands in very many of the documents here.")], "doc_id long, text string")
    more = index.insert(one)
    assert len(more.held[version]) == 498 and sum(map(len, more.held.values())) == 500
    back = more.delete(one)
    assert len(back.held[version]) == 498 and dropped(docs, back) == dropped(docs, index)


def test_parts_of_any_size_give_the_same(docs):
    index = lines.LineIndex.of(docs)
    found = [sorted((r.doc_id is None, r.doc_id, sorted(map(bytes, r.gone))) for r in x.collect()) for x in (index.dropped(), index.dropped(part_size=3), index.dropped(docs))]
    assert found[0] == found[1] == found[2] and found[0]


def test_keys_with_equal_buckets_and_fingerprints():
    keys = [bytes(8) + bytes([i]) * 8 for i in range(12)]
    made = lines.CuckooFilter(100)
    for k in keys:
        made.add(k)
    made = lines.CuckooFilter.from_bytes(made.to_bytes())
    for k in keys[:11]:
        assert made.delete(k) and made.has(keys[11])
    assert made.delete(keys[11]) and not made.has(keys[11]) and not made.delete(keys[11])


def test_cuckoo_filter():
    rnd = random.Random(3)
    keys = [rnd.randbytes(16) for _ in range(3000)]
    made = lines.CuckooFilter(1000)  # far too small: what finds no room is kept aside
    for k in keys:
        made.add(k)
    made = lines.CuckooFilter.from_bytes(made.to_bytes())
    assert all(made.has(k) for k in keys)
    roomy = lines.CuckooFilter(4000)
    for k in keys:
        roomy.add(k)
    assert not roomy.over
    for k in keys[::2]:
        assert roomy.delete(k)
    assert all(roomy.has(k) for k in keys[1::2])
    others = [rnd.randbytes(16) for _ in range(20_000)]
    assert sum(roomy.has(k) for k in others) < 40
    import numpy as np

    table = np.frombuffer(b"".join(keys + others), np.uint8).reshape(-1, 16)
    assert roomy.has_all(table).tolist() == [roomy.has(k) for k in keys + others]


# --- secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def brute_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def digest(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


TRICKY = ["token=token:abcdef", "token = x token=abcdefg", "é😀 secret='abcdef'", "AKIAAKIA" + "0" * 16, "x" * 5 + "AKIA" + "B" * 15, "0123456789abcdef0123456789abcdeg", "apikey:=abcdefg", "API_KEY==abcdef", "tokens: abcdefgh", "password:\tabcdefg", "paſſword=abcdefg", "toKen=abcdefg", "a" * 24 + "g" + "b" * 23]


def test_base_spans(spark, docs, clashing, empty, rows):
    for frame, data in ((docs, rows), (clashing, rows), (spark.createDataFrame([(i, t, "s") for i, t in enumerate(TRICKY)], "doc_id long, text string, source string"), list(enumerate(TRICKY)))):
        expected = Counter()
        for d, t in data:
            s = brute_spans(t)
            expected[d, *(sum(k == kind for _, _, k, _ in s) for kind in ("assign", "access", "hex")), sha(digest(s))] += 1
        got = secrets.query(frame).collect()
        assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == expected
        for r in got:  # the method only adds
            base = {f"{k}:{a}:{b}" for a, _, k, b in next(brute_spans(t) for d, t in data if d == r.doc_id)}
            assert base <= set(filter(None, r.spans.split(",")))
    assert secrets.query(empty).count() == 0


def test_owners_decide(spark):
    mine, theirs = "ghp_AbCdEf0123456789abcDEFghi", "ghp_ZyXwVu9876543210zyxWVUtsr"
    rows = [(i, f"key {theirs} end", f"owner{i}/repo") for i in range(8)] + [(50, f"my {mine}", "me/a"), (51, f"and {mine}", "me/a"), (52, "long_name_without_any_digits_at_all", "me/b"), (53, f"pwd: Zx9-81Kq7Lm2 and {theirs}", None)]
    got = {r.doc_id: r for r in secrets.query(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].spans == "" and got[i].n_example == 1 for i in range(8))
    assert got[50].spans == "random:3:32" and got[51].spans == "random:4:33" and got[52].spans == ""
    assert got[53].spans == "keyword:0:17" and got[53].n_example == 1


def test_redact(spark, docs, clashing, empty):
    out = secrets.redact(clashing)
    assert out.columns == clashing.columns and out.count() == docs.count() and secrets.redact(empty).count() == 0
    rows = [(1, "a password=abcdef AKIA" + "Q" * 16 + " z", "s", 0), (2, "secret=AKIA" + "Q" * 20, "s", 0), (3, "clean", "s", 77), (4, None, None, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")).collect()}
    assert got == {1: ("a <secret> <secret> z", 21), 2: ("<secret>", 8), 3: ("clean", 77), 4: (None, None)}
    for r in out.collect():
        assert not brute_spans(r.text), r.text


# --- urls

URLS = [None, "nope", "http://A.NET", "http://A.NET/", "x://net/a/b/c/d/e/f/g/h/i/j/k", "HTTP://Ex.Example.Net/en/?q#", "://org/fr/x/", "http://é.ORG/fr", "a://b?c/d://", "http://notexample.com/de/", "http://example.com/de/a//b", "http://example.net/EN/", "http://u@h:80/en/1#x?y", "http://x.example.net/en/p", "://", "a:///x"]


def brute_url(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = low(rest[:cut]), rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    best = max(((h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), key=lambda x: len(x[0]), default=(None, None))
    return host, path, *best


def test_urls(spark):
    rows = [(i, u, "html") for i, u in enumerate(URLS)] + [(3, URLS[3], None), (None, URLS[4], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    labels = spark.createDataFrame([(3, 0, 0), (3, 1, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = urls.query(pages, labels).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter((i, *brute_url(u)[:3]) for i, u, _ in rows)
    for r in got:
        v = brute_url(next(u for i, u, _ in rows if i == r.page_id))[3]
        assert r.verdict == v if v else r.verdict in ("allow", "block")
    assert urls.query(pages.limit(0), labels.limit(0)).count() == 0


def test_templates_and_purity(spark):
    """One branch of a host is bad: it stays apart, and its pages are rejected, those of the good branches are not."""
    pages, labels = [], []
    for i in range(1200):
        branch = ("news", "blog", "spam")[i % 3]
        pages.append((i, f"https://site.example.info/{branch}/{i * 7919}.html"))
        if i % 2:
            labels.append((i, 0 if branch == "spam" else 1, 0))
    got = urls.query(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len({r.template for r in got}) <= 3 and all(r.template.endswith("/*.html") for r in got)
    assert all(r.verdict == ("block" if "/spam/" in r.path else "allow") for r in got)
    same = [(i, u.replace("spam", "misc")) for i, u in pages]
    got = urls.query(spark.createDataFrame(same, "page_id long, url string"), spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], "doc_id long, quality int, toxic int")).collect()
    assert {r.template for r in got} == {"/~/*.html"} and {r.verdict for r in got} == {"allow"}


def test_a_host_of_unique_names_becomes_a_wildcard(spark):
    rnd = random.Random(1)
    pages = [(i, "http://h.info/" + "".join(rnd.choice("ghijklm") for _ in range(7))) for i in range(60)]
    none = spark.createDataFrame([], "page_id long, bad boolean")
    found = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), none)
    assert {r.template for r in found.collect()} == {"/*"}


def test_a_heavy_branch_among_unique_names_stays_apart(spark):
    rnd = random.Random(3)
    slugs = ["".join(rnd.choice("ghijklm") for _ in range(9)) for _ in range(200)]
    pages = [(i, f"http://h.info/{x}") for i, x in enumerate(slugs)] + [(200 + i, f"http://h.info/casino/{i}") for i in range(180)]
    labels = [(i, i >= 200) for i in range(380)]
    found = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean")).collect()
    assert {(r.template, r.verdict) for r in found} == {("/*", "allow"), ("/casino/*", "block")}


def test_sections_below_many_levels_stay_apart(spark):
    deep = "/".join("abcdefghijkl")
    pages = [(i, f"http://h.info/{deep}/{('good', 'bad')[i % 2]}/{i}") for i in range(100)] + [(100, "http://h.info/" + "x/" * 900 + "7.html")]
    labels = [(i, i % 2 == 1) for i in range(100)]
    found = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean")).collect()
    assert len(found) == 101 and all(r.verdict == ("block" if "/bad/" in r.path else "allow") for r in found if r.page_id < 100)
    assert next(r.template for r in found if r.page_id == 100) == "/~" * 900 + "/*.html"


def brute_templates(paths, tree):
    """The tree as plain recursion.  paths: {(host, path): (n, labelled, bad)}; the template of each."""
    out = {}

    def wild(x):
        return "*" + (re.search(r"(\.[A-Za-z]{1,5})$", x) or [""])[0]

    def is_wild(x):
        return re.fullmatch(r"(\*(\.[A-Za-z]{1,5})?)?", x) is not None

    def descend(members, template, level):
        for p in [p for p in members if len(p[1].split("/")) - 1 < level]:
            out[p] = template
        members = [p for p in members if len(p[1].split("/")) - 1 >= level]
        children = defaultdict(list)
        for p in members:
            children[p[1].split("/")[level]].append(p)
        total = lambda ps: [sum(paths[p][i] for p in ps) for i in range(3)]
        few = [total(c)[0] for c in children.values() if total(c)[0] < tree.few_pages]
        all_n, all_l, all_b = total(members)
        merged = defaultdict(list)
        for segment, c in children.items():
            n, lab, bad = total(c)
            rest = all_l - lab
            apart = False
            if lab >= tree.min_labels and rest >= tree.min_labels:
                pooled = all_b / all_l
                apart = abs(bad / lab - (all_b - bad) / rest) > tree.z * (pooled * (1 - pooled) * (1 / lab + 1 / rest)) ** 0.5
            if is_wild(segment):
                name = segment
            elif n < tree.few_pages and len(few) >= tree.many_children and sum(few) < len(few) * tree.pages_per_child:
                name = wild(segment)
            else:
                name = segment if apart else "~"
            merged[name] += c
        for name, c in merged.items():
            descend(c, f"{template}/{name}", level + 1)

    for host in {h for h, _ in paths}:
        descend([p for p in paths if p[0] == host], "", 1)
    return out


def test_templates_against_a_plain_tree(spark):
    rnd = random.Random(11)
    tree = urls.Tree(few_pages=3, many_children=6)
    pages, bad = [], {}
    for i in range(3000):
        depth = rnd.randrange(0, 5)
        parts = [rnd.choice(["news", "casino", "blog", "x", "", "a.html", "q" * rnd.randrange(1, 9), str(rnd.randrange(50)), "s" + "".join(rnd.choice("ghjk") for _ in range(5))]) for _ in range(depth)]
        pages.append((i, "https://" + rnd.choice(["a.info", "b.info", "c.info"]) + "".join("/" + x for x in parts)))
        if rnd.random() < 0.4:
            bad[i] = rnd.random() < (0.9 if "casino" in parts else 0.1)
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(list(bad.items()), "page_id long, bad boolean"), tree).collect()
    shape = lambda p: "/".join("*" + (re.search(r"(\.[A-Za-z]{1,5})$", x) or [""])[0] if re.search(r"^[0-9]+([._-]|$)", x) or (re.search(r"^[0-9a-fA-F-]{8,}(\.|$)", x) and re.search("[0-9]", x)) else x for x in p.split("/"))
    paths = defaultdict(lambda: [0, 0, 0])
    for r in got:
        x = paths[r.host, shape(r.path)]
        x[0] += 1
        x[1] += r.page_id in bad
        x[2] += bad.get(r.page_id, False)
    expected = brute_templates(paths, tree)
    prior = sum(bad.values()) / len(bad)
    share = defaultdict(lambda: [0, 0])
    for p, (_, lab, b) in paths.items():
        share[p[0], expected[p]][0] += lab
        share[p[0], expected[p]][1] += b
    for r in got:
        template = expected[r.host, shape(r.path)]
        lab, b = share[r.host, template]
        assert r.template == template
        assert r.verdict == ("block" if (b + tree.smoothing * prior) / (lab + tree.smoothing) >= tree.reject_share else "allow")
    assert len({r.template for r in got}) > 20 and {r.verdict for r in got} == {"allow", "block"}


def test_held_out_precision_and_recall(spark):
    """Four labels of five are given; the verdicts are held against the fifth."""
    rnd = random.Random(4)
    pages, truth = [], {}
    for i in range(4000):
        host, section = rnd.choice("abcd"), rnd.choice(["news", "win", "blog", "deals", "about"])
        pages.append((i, f"https://{host}.info/{section}/{rnd.randrange(10**6)}"))
        truth[i] = rnd.random() < (0.95 if section == "win" or host + section == "adeals" else 0.05)
    given = [(i, b) for i, b in truth.items() if i % 5]
    verdict = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(given, "page_id long, bad boolean")).collect()}
    held = [i for i in truth if i % 5 == 0]
    hit = sum(truth[i] and verdict[i] == "block" for i in held)
    assert hit > 0.8 * sum(truth[i] for i in held) and hit > 0.9 * sum(verdict[i] == "block" for i in held)
