"""URL filters by a path-template tree; DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, materialize_with, packed


@dataclass(frozen=True)
class Rule:
    """`name` is host and path, as in `example.org/es/`; it fits the host and its subdomains where the path starts with its path."""

    verdict: str
    name: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.name.partition("/")[2]

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith(F.col("host"), F.lit("." + self.host))
        return host & F.startswith(F.col("path"), F.lit(self.path))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty where there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty where there is no `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, url_col: str = "url", variable_children: int = 12, smoothing: float = 4.0, alpha: float = 0.05, reject: float = 0.8) -> DataFrame:
    """`pages` with columns host, path, rule (of the longest rule that fits, else null), template, purity and verdict.

    Where a rule fits, it decides. The others are judged by the template of their path:

    1. Segments that hold a digit become `*` with their extension kept; urls collapse to (host, shape) counts.
    2. The tree of each host is built from the root down, to the depth of its paths: a step for each level at which any
       node branches, and one for the chain of single children before it, however long. A node whose children (distinct
       segments under one host and template) are more than `variable_children` is variable and its children become `*`.
    3. Siblings merge when their branches are statistically similar, whatever their labels: no child's share of the
       urls differs by more than the Hoeffding bound for both numbers of urls at level `alpha`; children of a variable
       node are one. From the most frequent sibling on, each joins the first group whose first member it is like.
    4. Purity of a template: (blocked + smoothing * purity of its parent) / (labelled + smoothing), so that one without
       labels has its parent's; the parent of a root is the blocked share of all labelled urls (one half if there is none).
       Templates with purity >= `reject` are blocked.

    Labels: `labels` (url, blocked boolean), or where None the urls that a rule decides. Null urls and those without
    `://` have empty host and path. All rows pass through; input columns named as results are replaced; an
    empty table gives none. Every aggregate has partial sums before its shuffle, what is gathered per node is bounded by
    `variable_children`, and rows meet templates in joins whose hot hosts AQE splits.
    """
    ours = ("host", "path", "rule", "template", "purity", "verdict")
    rows, _ = packed(pages, url_col, drop=tuple(c for c in ours if c != url_col))
    rows = rows.select(F.col(url_col).alias("__url"), "__rest", host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    best = sorted(rules, key=lambda r: (-len(r.name), r.name))
    rule, by_rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(best):
        rule, by_rule = F.when(r.fits(), r.name).otherwise(rule), F.when(r.fits(), r.verdict).otherwise(by_rule)
    rows = rows.withColumn("rule", rule).withColumn("__by_rule", by_rule).withColumn("__shape", _shape())
    if labels is None:
        blocked = rows.select("host", "__shape", F.when(F.col("__by_rule") == "block", 1).when(F.col("__by_rule") == "allow", 0).alias("b"))
    else:
        known = labels.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("blocked").cast("int").alias("b"))
        blocked = known.withColumn("__shape", _shape()).select("host", "__shape", "b").unionByName(rows.select("host", "__shape", F.lit(None).cast("int").alias("b")))
    shapes = blocked.groupBy("host", "__shape").agg(F.count("*").alias("n"), F.count("b").alias("labelled"), F.coalesce(F.sum("b"), F.lit(0)).alias("bad"))
    known = _tree(shapes, variable_children, smoothing, alpha)
    verdict = F.coalesce(F.col("__by_rule"), F.when(F.col("purity") >= reject, "block").otherwise("allow"))
    found = rows.join(known, ["host", "__shape"], "left").withColumn("verdict", verdict)
    kept = [F.col("__url").alias(url_col) if c == url_col else F.col("__rest").getField(c).alias(c) for c in pages.columns if c not in ours]
    return found.select(*kept, *ours)


def _shape() -> Column:
    """The segments of the path, with `*` for those that hold a digit (an extension of letters stays)."""
    return F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), lambda s: F.when(s.rlike("[0-9]"), F.concat(F.lit("*"), F.regexp_extract(s, r"(\.[A-Za-z]+)$", 1))).otherwise(s))


def _tree(shapes: DataFrame, variable_children: int, smoothing: float, alpha: float) -> DataFrame:
    """(host, __shape) -> template, purity."""
    shapes = materialize(shapes)
    bad, labelled = shapes.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("labelled"), F.lit(0))).first()
    node, at = _with_purity(shapes.withColumns({"template": F.lit(""), "purity": F.lit(bad / labelled if labelled else 0.5)}), F.lit(True), smoothing), ["host", "template"]
    share = "coalesce(try_element_at({}, k), 0D)".format
    bound = f"{math.sqrt(math.log(2 / alpha) / 2)!r} * (1 / sqrt(g.n) + 1 / sqrt(-x.first)) + 1e-9"
    like = f"array_position(transform(acc, g -> forall(array_union(map_keys(g.lead), map_keys(x.kids)), k -> abs({share('g.lead')} - {share('x.kids')}) <= {bound})), true)"
    groups = F.expr(
        f"""aggregate(array_sort(sibs, (p, q) -> CASE WHEN p.first < q.first THEN -1 WHEN p.first > q.first THEN 1 WHEN p.seg < q.seg THEN -1 WHEN p.seg > q.seg THEN 1 ELSE 0 END),
        CAST(array() AS array<struct<lead: map<string, double>, n: bigint, members: array<string>>>), (acc, x) -> IF({like} > 0,
        transform(acc, (g, i) -> IF(i + 1 = {like}, named_struct('lead', g.lead, 'n', g.n, 'members', concat(g.members, array(x.seg))), g)),
        concat(acc, array(named_struct('lead', x.kids, 'n', -x.first, 'members', array(x.seg))))))"""
    )
    node, done = node.withColumn("__k", F.lit(0)), []
    while True:
        done.append(node.where(F.col("__k") >= F.size("__shape")))
        node, longest = materialize_with(_down_chains(node.where(F.col("__k") < F.size("__shape")), smoothing), F.max(F.size("__shape") - F.col("__k")))
        done.append(node.where(F.col("__k") >= F.size("__shape")))
        if not longest:
            break
        # Of the nodes that branch, one level; a node's paths have as many segments behind them, `__k`.
        node = node.where(F.col("__k") < F.size("__shape")).withColumn("__seg", F.get("__shape", F.col("__k")))
        wide = node.groupBy(*at, "__seg").agg(F.lit(1)).groupBy(*at).agg(F.count("*").alias("__kids")).where(F.col("__kids") > variable_children)
        node = node.join(wide, at, "left").withColumn("__seg", F.when(F.col("__kids").isNotNull(), "*").otherwise(F.col("__seg"))).drop("__kids")
        kids = node.groupBy(*at, "__seg", F.coalesce(F.get("__shape", F.col("__k") + 1), F.lit("")).alias("kid")).agg(F.sum("n").alias("n"))
        sizes = kids.groupBy(*at, "__seg").agg(F.sum("n").alias("all"), F.count(F.nullif("kid", F.lit(""))).alias("many"))
        kid = F.when((F.col("many") > variable_children) & (F.col("kid") != ""), "*").otherwise(F.col("kid"))
        kids = kids.join(sizes, [*at, "__seg"]).groupBy(*at, "__seg", "all", kid.alias("kid")).agg((F.sum("n") / F.col("all")).alias("share"))
        sibs = kids.groupBy(*at, "__seg", "all").agg(F.map_from_entries(F.collect_list(F.struct("kid", "share"))).alias("kids")).groupBy(*at).agg(F.collect_list(F.struct((-F.col("all")).alias("first"), F.col("__seg").alias("seg"), "kids")).alias("sibs"))
        named = sibs.select(*at, F.explode(F.transform(groups, lambda g: g["members"])).alias("m"))
        name = F.when(F.size("m") > 1, F.concat(F.lit("{"), F.array_join(F.sort_array("m"), "|"), F.lit("}"))).otherwise(F.col("m")[0])
        named = named.select(*at, F.explode("m").alias("__seg"), name.alias("__name"))
        node = node.join(named, [*at, "__seg"]).withColumn("template", F.concat("template", F.lit("/"), "__name")).withColumn("__k", F.col("__k") + 1)
        node = materialize(_with_purity(node, F.lit(True), smoothing).select(*done[0].columns))  # the plan would grow by some of itself a level
    found = reduce(DataFrame.unionByName, done)
    return found.select("host", "__shape", F.when(F.col("template") == "", "/").otherwise(F.col("template")).alias("template"), "purity")


def _down_chains(node: DataFrame, smoothing: float) -> DataFrame:
    """Each path moved down, in one step however long, while the paths of its node have one child at every level or end there.

    Nothing merges on the way and every name is a segment, so the template is a slice of the path, and the purity that
    of one node after the other: with b of l labelled urls blocked, after m levels b / l + (s / (l + s))**m * (p - b / l);
    where labelled paths end, b and l change. What is gathered of a node are its longest path and sums by depth, as long
    as a path at most.
    """
    at, rest = ["host", "template"], F.slice("__shape", F.col("__k") + 1, F.size("__shape"))
    node = node.withColumn("__rest", rest)
    tops = node.groupBy(*at).agg(F.max_by("__rest", F.struct(F.size("__rest"), "__rest")).alias("__top"))
    node = node.join(tops, at).withColumn("__size", F.size("__rest"))
    differs = F.expr("array_position(transform(sequence(1, __size), i -> __rest[i - 1] <> __top[i - 1]), true)").cast("int")
    node = node.withColumn("__differs", differs)
    ends = node.groupBy(*at).agg(F.least(F.min(F.when(F.col("__differs") > 0, F.col("__differs") - 1)), F.max("__size")).alias("__m"))
    by_end = node.join(ends, at).withColumn("__d", F.least("__m", "__size"))
    sums = by_end.where("__m > 0").groupBy(*at, "__d").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("l"), F.max("purity").alias("p"))
    sums = sums.groupBy(*at).agg(F.array_sort(F.collect_list(F.struct(F.col("__d").alias("d"), "b", "l"))).alias("__ends"), F.max("p").alias("__p"), F.sum("b").alias("__b"), F.sum("l").alias("__l"))
    s = repr(float(smoothing))
    # From one depth at which paths end to the next; `p` of the last step, `b` and `l` of the paths that go on, `out` the purity at each depth.
    step = f"if(acc.l = 0, acc.p, acc.b / acc.l + power({s} / (acc.l + {s}), x.d - acc.d) * (acc.p - acc.b / acc.l))"
    fold = f"""aggregate(__ends, named_struct('d', 0, 'p', __p, 'b', __b, 'l', __l, 'out', cast(map() as map<int, double>)),
        (acc, x) -> named_struct('d', x.d, 'p', {step}, 'b', acc.b - x.b, 'l', acc.l - x.l, 'out', map_concat(acc.out, map(x.d, {step}))), acc -> acc.out)"""
    sums = sums.select(*at, F.expr(fold).alias("__purities"))
    out = by_end.join(sums, at, "left").withColumn("purity", F.when(F.col("__m") > 0, F.try_element_at("__purities", F.col("__d"))).otherwise(F.col("purity")))
    out = out.withColumn("template", F.when(F.col("__d") > 0, F.concat("template", F.lit("/"), F.array_join(F.slice("__rest", F.lit(1), F.col("__d")), "/"))).otherwise(F.col("template")))
    return out.withColumn("__k", F.col("__k") + F.col("__d")).drop("__rest", "__top", "__size", "__differs", "__m", "__d", "__purities")


def _with_purity(node: DataFrame, new: Column, smoothing: float) -> DataFrame:
    """`purity`, that of the parent so far, of the templates where `new` holds, from the labels of all urls below them."""
    sums = node.where(new).groupBy("host", "template").agg(F.sum("bad").alias("__b"), F.sum("labelled").alias("__l"))
    own = (F.col("__b") + smoothing * F.col("purity")) / (F.col("__l") + smoothing)
    return node.join(sums, ["host", "template"], "left").withColumn("purity", F.when(new, own).otherwise(F.col("purity"))).drop("__b", "__l")
