"""URL filter by a path-template tree, with DataFrame functions only.

Rules judge first. What they judge is the labelled set from which templates learn. Per host
the path's segments form a tree. A segment that looks like an id (has a digit) is a wildcard
at once; below a node, children become one wildcard when there are many of them and most
occur once (a slot for values, not a fixed word). Sibling branches under the same parent are
merged when both are labelled and a branch's share of blocked pages does not differ
significantly from its siblings' (two-proportion z). The share is smoothed down the tree,
``(blocked + a * above) / (labelled + a)``: the branch towards the share of all labelled
pages, the template towards its branch. A template is rejected when that reaches the limit;
one whose branch has no labels is allowed.

All work is on distinct (host, path) with counts, so a page repeated a million times is one
row, and each segment is a row of its own, counted per node with partial aggregation.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule and the
verdict allow; an empty path is the template of its host's root; repeated rows are judged
alike; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.session import materialize

#: (verdict, host, path) - fixed values of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: A node's children are one wildcard from so many distinct ones, if at least this share of
#: the distinct pages below has a child of its own.
MANY_CHILDREN = 20
OWN_CHILD_SHARE = 0.5
Z_LIMIT = 1.96
SMOOTHING = 4.0
REJECT_FROM = 0.9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def split_url(pages: DataFrame) -> DataFrame:
    """Adds host and path."""
    url = F.col("url")
    rest = F.when(F.instr(url, "://") > 0, _after_scheme(url)).otherwise(F.lit(""))
    raw_host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(raw_host) + 1, F.length(rest))
    return pages.withColumns(
        {
            "host": F.translate(raw_host, _UPPER, _LOWER),
            "path": F.regexp_extract(tail, r"^[^?#]*", 0),
        }
    )


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, of_host, of_path = rule
    return ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(path, F.lit(of_path))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = _fits(host, path, rule)
        name = F.when(fits, F.lit(rule[1] + rule[2])).otherwise(name)
        verdict = F.when(fits, F.lit(rule[0])).otherwise(verdict)
    return name, verdict


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, template, purity, verdict for each page."""
    placed = split_url(pages.select("page_id", "url"))
    name, ruled = rule_of(F.col("host"), F.col("path"), rules)
    placed = placed.withColumns({"rule": name, "ruled": ruled})
    places = materialize(
        placed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.first("ruled").alias("ruled")),
        "url_places",
    )
    templates = path_templates(places)
    verdicts = template_verdicts(templates)
    judged = placed.join(verdicts.select("host", "path", "template", "purity", "reject"), ["host", "path"])
    own = F.when(F.col("reject"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "url", "host", "path", "rule", "template", "purity", F.coalesce("ruled", own).alias("verdict")
    )


def path_templates(places: DataFrame) -> DataFrame:
    """Adds ``template`` and ``branch`` (its first segment generalised) to distinct places."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    shape = F.transform(segments, lambda s: F.when(s.rlike("[0-9]"), F.lit("*")).otherwise(s))
    shaped = places.withColumn("shape", shape)
    # a node is (host, depth, hash of what stands above), so that long paths do not square
    nodes = shaped.select("host", "path", "pages", F.posexplode("shape").alias("depth", "segment"), "shape")
    nodes = nodes.withColumn(
        "above", F.md5(F.array_join(F.slice("shape", F.lit(1), F.col("depth")), "/"))
    ).drop("shape")
    children = nodes.groupBy("host", "depth", "above", "segment").agg(F.count(F.lit(1)).alias("places"))
    slots = children.groupBy("host", "depth", "above").agg(
        F.count(F.lit(1)).alias("children"), F.sum("places").alias("places")
    )
    slots = slots.where(
        (F.col("children") >= MANY_CHILDREN) & (F.col("children") >= F.col("places") * OWN_CHILD_SHARE)
    ).select("host", "depth", "above", F.lit(True).alias("slot"))
    cut = nodes.join(slots, ["host", "depth", "above"], "left").withColumn(
        "segment", F.when(F.col("slot"), F.lit("*")).otherwise(F.col("segment"))
    )
    parts = cut.groupBy("host", "path").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("depth", "segment"))), lambda x: x["segment"]).alias("parts")
    )
    joined = places.join(parts, ["host", "path"], "left").withColumn(
        "parts", F.coalesce("parts", F.array().cast("array<string>"))
    )
    return joined.select(
        "host", "path", "pages", "ruled",
        F.concat(F.lit("/"), F.array_join("parts", "/")).alias("template"),
        F.coalesce(F.get("parts", F.lit(0)), F.lit("")).alias("branch"),
    )


def template_verdicts(templates: DataFrame) -> DataFrame:
    """Adds purity and reject to places with templates."""
    labelled = F.when(F.col("ruled").isNotNull(), F.col("pages")).otherwise(0)
    blocked = F.when(F.col("ruled") == "block", F.col("pages")).otherwise(0)
    counted = templates.groupBy("host", "branch", "template").agg(
        F.sum(labelled).alias("labelled"), F.sum(blocked).alias("blocked")
    )
    counted = materialize(counted, "url_templates")
    branches = counted.groupBy("host", "branch").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
    )
    hosts = branches.groupBy("host").agg(F.sum("labelled").alias("n_host"), F.sum("blocked").alias("b_host"))
    whole = hosts.agg(F.sum("n_host").alias("n_all"), F.sum("b_host").alias("b_all"))
    n_all, b_all = whole.first() or (0, 0)
    prior = (b_all or 0) / n_all if n_all else 0.0
    # a labelled branch joins its labelled siblings when its share does not differ from theirs
    n_rest, b_rest = F.col("n_host") - F.col("labelled"), F.col("b_host") - F.col("blocked")
    pooled = F.try_divide("b_host", "n_host")
    parts = F.try_divide(F.lit(1.0), F.col("labelled")) + F.try_divide(F.lit(1.0), n_rest)
    gap = F.abs(F.try_divide("blocked", "labelled") - F.try_divide(b_rest, n_rest))
    alike = F.coalesce(gap <= Z_LIMIT * F.sqrt(pooled * (1 - pooled) * parts), F.lit(False))
    merged = branches.join(hosts, "host").select(
        "host",
        "branch",
        F.when(alike, F.col("n_host")).otherwise(F.col("labelled")).alias("n_branch"),
        F.when(alike, F.col("b_host")).otherwise(F.col("blocked")).alias("b_branch"),
    )
    of_branch = (F.col("b_branch") + SMOOTHING * prior) / (F.col("n_branch") + SMOOTHING)
    purity = (F.col("blocked") + SMOOTHING * of_branch) / (F.col("labelled") + SMOOTHING)
    scored = counted.join(merged, ["host", "branch"]).select(
        "host",
        "branch",
        "template",
        purity.alias("purity"),
        ((F.col("n_branch") > 0) & (purity >= REJECT_FROM)).alias("reject"),
    )
    return templates.join(scored, ["host", "branch", "template"])


def url_digest(pages: DataFrame) -> DataFrame:
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
