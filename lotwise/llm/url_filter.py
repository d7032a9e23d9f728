"""URL verdicts by rules and, where none fits, by a tree of path templates.

Rules name a host with its subdomains and the start of a path; the longest
that fits decides, and its verdict is also the label from which the tree learns.

Per host, a path's segments are first written by their shape (digits, hex, mixed) and
then walked level by level to `DEPTH`. Under a template, a segment stays a branch
of its own if it has `SUPPORT` urls and its share of blocked labels differs from that of its siblings
by `APART` standard errors; statistically similar branches are merged into one wildcard.
What lies deeper than the tree is one wildcard more. A template's purity is its
share of blocked labels, smoothed by `PRIOR` urls of its host's share, which is
smoothed alike by that of all labels; templates above `REJECT` are blocked.

DataFrame functions only. Scale: urls are counted by host and shape before the
tree is built, so levels work on distinct shapes; each is a sum per branch
and a join on it. The urls meet their template in one join on host and shape, whose
one side has a row per key.

Defined cases. A null url, or one without `://`, has an empty host and path,
which is a template like any other. Repeated urls count as often as they occur; all rows stay, those without an id too. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import ascii_lower
from lotwise.operators.staging import stage

DEPTH = 4
SUPPORT = 5
APART = 2.0
PRIOR = 8.0
REJECT = 0.5
WILD = "*"
REST = "**"


@dataclass(frozen=True)
class Rule:
    """`text` is a host, then the start of a path from its first slash."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text[: self.text.index("/")]

    @property
    def path(self) -> str:
        return self.text[self.text.index("/") :]

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


def split_url(url: str) -> tuple[Column, Column]:
    """host and path."""
    whole = F.coalesce(F.col(url), F.lit(""))
    after = F.when(F.instr(whole, "://") > 0, F.substring(whole, F.instr(whole, "://") + 3, F.length(whole))).otherwise("")
    return (
        ascii_lower(F.regexp_extract(after, r"^[^/?#]*", 0)),
        F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1),
    )


def shape(segment: Column) -> Column:
    """Digits, hex and mixed words by placeholder; what follows a dot stays."""
    name, end = F.regexp_extract(segment, r"^([^.]*)", 1), F.regexp_extract(segment, r"^[^.]*(.*)", 1)
    kind = (
        F.when(name.rlike(r"^[0-9]+$"), "{n}")
        .when(name.rlike(r"^[0-9a-f]{8,}$"), "{x}")
        .when(name.rlike(r"[0-9]"), "{m}")
        .otherwise(name)
    )
    return F.concat(kind, end)


def with_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule and ruled (its verdict), null where none fits; the longest rule wins."""
    longest = sorted(rules, key=lambda r: (-len(r.text), r.text))

    def choice(value) -> Column:
        # nested from the shortest rule outwards
        return reduce(lambda rest, r: F.when(r.fits(), value(r)).otherwise(rest), reversed(longest), F.lit(None).cast("string"))

    return urls.withColumn("rule", choice(lambda r: r.text)).withColumn("ruled", choice(lambda r: r.verdict))


def _share(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + PRIOR * prior) / (labelled + PRIOR)


def tree_level(paths: DataFrame, level: int) -> DataFrame:
    """paths: host, shape, steps, template, n, labelled, blocked; the template grows by a step."""
    step = F.get("steps", F.lit(level))
    at = paths.where(step.isNotNull()).withColumn("step", step)
    branches = at.groupBy("host", "template", "step").agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b")
    )
    nodes = branches.groupBy("host", "template").agg(
        F.sum("l").alias("node_l"), F.sum("b").alias("node_b"), F.count("*").alias("kids")
    )
    rest_l, rest_b = F.col("node_l") - F.col("l"), F.col("node_b") - F.col("b")
    own, rest = (F.col("b") + 0.5) / (F.col("l") + 1), (rest_b + 0.5) / (rest_l + 1)
    pooled = (F.col("node_b") + 1) / (F.col("node_l") + 2)
    # squares, so that no root is taken
    error = pooled * (1 - pooled) * (1 / (F.col("l") + 1) + 1 / (rest_l + 1))
    apart = (own - rest) * (own - rest) > APART * APART * error
    single = F.col("kids") == 1
    branches = branches.join(nodes, ["host", "template"]).select(
        "host", "template", "step", F.when(single | ((F.col("n") >= SUPPORT) & apart), F.col("step")).otherwise(WILD).alias("branch")
    )
    grown = at.join(branches, ["host", "template", "step"]).select(
        "host", "shape", "steps", F.concat_ws("/", "template", "branch").alias("template"), "n", "labelled", "blocked"
    )
    return grown.unionByName(paths.where(step.isNull()))


def templates(urls: DataFrame) -> DataFrame:
    """urls: host, shape, ruled. host, shape, template, purity: one row per distinct host and shape."""
    paths = stage(
        urls.groupBy("host", "shape").agg(
            F.count("*").alias("n"),
            F.count("ruled").alias("labelled"),
            F.sum((F.coalesce(F.col("ruled"), F.lit("")) == "block").cast("long")).alias("blocked"),
        ),
        "url-shapes",
    ).select("host", "shape", F.split("shape", "/").alias("steps"), F.lit("").alias("template"), "n", "labelled", "blocked")
    every = paths.agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")).first()
    overall = F.lit(((every["b"] or 0) + 1.0) / ((every["l"] or 0) + 2.0))
    for level in range(DEPTH):
        paths = stage(tree_level(paths, level), f"url-level-{level}")  # else every level repeats those before it
    deep = F.size("steps") > DEPTH
    paths = stage(
        paths.withColumn("template", F.when(deep, F.concat_ws("/", "template", F.lit(REST))).otherwise(F.col("template"))),
        "url-templates",
    )
    hosts = paths.groupBy("host").agg(F.sum("labelled").alias("host_l"), F.sum("blocked").alias("host_b"))
    kinds = paths.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    purity = _share(F.col("b"), F.col("l"), _share(F.col("host_b"), F.col("host_l"), overall))
    judged = kinds.join(hosts, "host").select("host", "template", purity.alias("purity"))
    return paths.select("host", "shape", "template").join(judged, ["host", "template"])


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of pages: key, host, path, rule, verdict, template, purity."""
    host, path = split_url(url)
    urls = with_rules(pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path")), rules)
    steps = F.split(F.regexp_replace("path", "^/", ""), "/")
    urls = urls.withColumn("shape", F.array_join(F.transform(steps, shape), "/"))
    known = templates(urls)
    blocked = F.when(F.col("purity") > REJECT, "block").otherwise("allow")
    return urls.join(known, ["host", "shape"]).select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", blocked).alias("verdict"), "template", "purity"
    )
