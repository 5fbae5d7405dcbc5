"""URL filters: host and path rules, then the verdict of a path-template tree.

Per host, the paths of all pages form a tree.  Segments that are numbers or hashes become wildcards that keep their
ending before anything is counted.  Then, level by level, the children of a node that have few pages and nearly all differ
become wildcards too.  Each of the others is compared with its siblings: it stays a branch of its own if it has labels
enough and its share of bad pages differs from theirs by more than chance (a test of two proportions); all that are
alike are merged into one.  A path's way through the tree is its template; a template is rejected by its labelled purity,
smoothed towards that of the corpus.

Pages are counted by host and generalised path, combined before the shuffle, so a host with a third of all pages costs
little more than any other; the levels work on these counts and are written to cut the lineage.  They run to the
deepest path; a path that is alone under its template is named to its end at once.

Results for special cases: a null url or one without "://" has an empty host and path, no rule and the verdict of the
empty template; repeated rows get a row each; null page ids have no label; unlabelled templates have the corpus' purity, and
an exact tie with the limit is rejected; paths of any depth are taken whole; an empty table gives an empty result; other
columns of the tables play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, saved

#: Fixed values of the contract: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@dataclass(frozen=True)
class Tree:
    #: A child with fewer pages than this has few.
    few_pages: int = 5
    #: A node's children with few pages vary if there are so many, with fewer pages for each than this.
    many_children: int = 20
    pages_per_child: float = 2.0
    #: A branch stays apart if it has so many labels and its share of bad pages is so many standard errors from its siblings'.
    min_labels: int = 5
    z: float = 2.58
    #: Pages' worth of the corpus' share that every template's share is smoothed by, and the share that is rejected.
    smoothing: float = 5.0
    reject_share: float = 0.5


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    none = url.isNull() | (at == 0)
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(none, "").otherwise(host), F.when(none, "").otherwise(path)


def rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as (rule, verdict); nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer one goes before
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _variable(segment: Column) -> Column:
    return segment.rlike(r"^[0-9]+([._-]|$)") | segment.rlike(r"^[0-9a-fA-F-]{8,}(\.|$)") & segment.rlike("[0-9]")


def _wildcard(segment: Column) -> Column:
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1))


def shape(path: Column) -> Column:
    """The path with its numbers and hashes made wildcards."""
    return F.array_join(F.transform(F.split(path, "/"), lambda x: F.when(_variable(x), _wildcard(x)).otherwise(x)), "/")


def _is_wildcard(segment: Column) -> Column:
    return segment.rlike(r"^(\*(\.[A-Za-z]{1,5})?)?$")


def templates(paths: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """paths: host, path (a shape; distinct), n, labelled, bad.  The same with template."""
    state = saved(paths.withColumns({"segments": F.split("path", "/"), "template": F.lit(""), "alone": F.lit(False)}))
    finished, level = [], 0
    while True:
        # a path has ended, or its rest has been named as it was alone under its template
        ended = F.col("alone") | (F.size("segments") - 1 <= level)
        finished.append(state.filter(ended))
        state = state.filter(~ended)
        if state.isEmpty():
            return reduce(DataFrame.union, finished).drop("segments", "alone")
        level += 1
        here = state.withColumn("segment", F.get("segments", F.lit(level)))
        keys = [F.col(c).alias(f"k_{c}") for c in ("host", "template", "segment")]
        children = here.filter(F.col("segment").isNotNull()).groupBy(*keys).agg(F.count("*").alias("paths"), *(F.sum(c).alias(c) for c in ("n", "labelled", "bad")))
        few = F.col("n") < tree.few_pages
        nodes = children.groupBy(F.col("k_host").alias("n_host"), F.col("k_template").alias("n_template")).agg(
            F.count_if(few).alias("children"), F.sum(F.when(few, F.col("n"))).alias("pages"), (F.sum("paths") == 1).alias("k_alone"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
        )
        joined = children.drop("paths").join(nodes, (F.col("k_host") == F.col("n_host")) & (F.col("k_template") == F.col("n_template")))
        varied = few & (F.col("children") >= tree.many_children) & (F.col("pages") < F.col("children") * tree.pages_per_child)
        others, all_ = F.col("all_labelled") - F.col("labelled"), F.col("all_labelled")
        pooled = F.col("all_bad") / all_
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / others))
        apart = F.abs(F.col("bad") / F.col("labelled") - (F.col("all_bad") - F.col("bad")) / others) > tree.z * error
        alike = ~F.when((F.col("labelled") >= tree.min_labels) & (others >= tree.min_labels), apart).otherwise(False)
        name = F.when(_is_wildcard(F.col("k_segment")), F.col("k_segment")).when(varied, _wildcard(F.col("k_segment"))).when(alike, "~").otherwise(F.col("k_segment"))
        named = joined.select("k_host", "k_template", "k_segment", "k_alone", name.alias("name"))
        same = (F.col("host") == F.col("k_host")) & (F.col("template") == F.col("k_template")) & (F.col("segment") == F.col("k_segment"))
        # alone, each further segment is the only child of its node, whose share is its own
        rest = F.transform(F.slice("segments", level + 1, F.size("segments")), lambda x: F.when(_is_wildcard(x), x).otherwise("~"))
        template = F.concat("template", F.lit("/"), F.when(F.col("k_alone"), F.array_join(rest, "/")).otherwise(F.col("name")))
        state = saved(here.join(named, same).select("host", "path", "n", "labelled", "bad", "segments", template.alias("template"), F.col("k_alone").alias("alone")))


def judge(pages: DataFrame, labels: DataFrame, tree: Tree = Tree(), rules: tuple = RULES) -> DataFrame:
    """pages: page_id, url; labels: page_id, bad (boolean).  page_id, host, path, rule, verdict, template, bad_share."""
    host, path = host_path(F.col("url"))
    parsed = saved(pages.select("page_id", host.alias("host"), path.alias("path")))
    known = labels.filter("page_id is not null and bad is not null").groupBy(F.col("page_id").alias("labelled_id")).agg(F.max("bad").alias("is_bad"))
    marked = parsed.join(known, F.col("page_id") == F.col("labelled_id"), "left")
    paths = marked.groupBy("host", shape(F.col("path")).alias("path")).agg(F.count("*").alias("n"), F.count("is_bad").alias("labelled"), F.count_if("is_bad").alias("bad"))
    found = templates(paths, tree)
    total = found.agg(F.sum("bad"), F.sum("labelled")).first()
    prior = (total[0] or 0) / max(1, total[1] or 0)
    shares = found.groupBy(F.col("host").alias("t_host"), F.col("template").alias("t_template")).agg(((F.sum("bad") + tree.smoothing * prior) / (F.sum("labelled") + tree.smoothing)).alias("bad_share"))
    judged = found.join(shares, (F.col("host") == F.col("t_host")) & (F.col("template") == F.col("t_template")))
    judged = judged.select(F.col("host").alias("j_host"), F.col("path").alias("j_path"), "template", "bad_share")
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    out = parsed.join(judged, (F.col("host") == F.col("j_host")) & (shape(F.col("path")) == F.col("j_path")))
    method = F.when(F.col("bad_share") >= tree.reject_share, "block").otherwise("allow")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", "bad_share")


def query(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``op10_url_filters``; a page's label is that of the document with its id: bad if toxic or of low quality."""
    bad = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge(pages, bad)
