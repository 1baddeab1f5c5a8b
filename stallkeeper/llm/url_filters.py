"""Judge urls by rules, and beyond them by the labelled purity of path templates.

Paths of a host form a tree.  Digits and hex runs in a segment become wildcards by shape.  Going down, the
children of a node are dealt to bins by their share of bad urls; bins are pooled in order while their shares
do not differ significantly, and what is left are the node's branches.  A branch of one segment keeps it, one
of several becomes a wildcard, and its paths go on as one.  The share of a branch is smoothed towards its
parent's, so one with few labels is judged like what lies above it; where all children are one branch they
tell nothing, and are judged as their parent.  A node is final once its urls do not differ.  This holds at
every level, however long paths are.

Urls are counted by host and shape first, combined before the shuffle; the levels work on those counts.  A
node's children are combined by bin before any shuffle too, so a list has BINS entries at most, however many
children a node has.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import lower_ascii
from stallkeeper.session import Cut, table_cut

# Bins of bad shares, of equal width in the angle whose sine squared is the share: there, shares of equal
# weight spread alike.
BINS = 32
# A bin joins a branch if the z value of their bad shares is below this.
SIMILAR = 1.96
# Weight of the parent's share, the share assumed above all hosts, and what an unlabelled url counts as good.
PRIOR = 4.0
ROOT = 0.1
UNLABELLED = 0.2
# Templates with at least this smoothed share of bad urls are rejected.
REJECT = 0.5

# Words in a host's name that label its urls as bad.
BAD_WORDS = ("ads", "adult", "bets", "betting", "casino", "pills", "poker", "spam", "viagra", "xxx")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, parts, 1)), F.regexp_extract(text, parts, 2)


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls.

    A rule is a host and a path prefix in one text; it fits the host and all its subdomains.  Rules are a
    parameter and few: each is one condition of the plan.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = text.partition("/")
        own = (host == name) | F.endswith(host, F.lit("." + name))
        fits = own & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(rules[text])).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """Shapes of a path's segments; hex runs of 8 or more and digits are wildcards."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.transform(
        parts, lambda p: F.regexp_replace(F.regexp_replace(p, r"(?=[0-9a-f]*[0-9])[0-9a-f]{8,}", "{x}"), r"[0-9]+", "{n}")
    )


def _weight() -> Column:
    """What a node's urls count for; from whole numbers, so equal counts are equal weights."""
    return F.col("labelled") + UNLABELLED * (F.col("n") - F.col("labelled"))


def _apart(bad: Column, weight: Column, other_bad: Column, other_weight: Column, similar: float) -> Column:
    """Whether two shares of bad urls differ significantly."""
    pooled = (bad + other_bad) / (weight + other_weight)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / weight + 1 / other_weight))
    gap = F.abs(bad / weight - other_bad / other_weight)
    return (gap > 0) & (gap >= similar * spread)


def bin_borders() -> list[float]:
    """Shares at which bins begin, but for the first; the last begins at 1."""
    return [math.sin(math.pi / 2 * k / BINS) ** 2 for k in range(1, BINS)] + [1.0]


def _bin(share: Column) -> Column:
    """How many borders a share has reached."""
    return F.size(F.filter(F.array(*map(F.lit, bin_borders())), lambda border: border <= share))


def _branched(children: DataFrame, similar: float) -> DataFrame:
    """Children with their branch: its number, bad urls, weight and children, and how many branches there are.

    In the order of their shares, each bin joins the branch before it or, if it differs from all of that
    branch together, starts the next.
    """
    children = children.withColumn("weight", _weight()).withColumn("bin", _bin(F.col("bad") / F.col("weight")))
    bins = children.groupBy("host", "template", "bin").agg(
        F.sum("bad").alias("bad"), F.sum("weight").alias("weight"), F.count("*").alias("of")
    )
    lists = bins.groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("bin", "bad", "weight", "of"))).alias("bins"))

    def joined(s: Column, t: Column) -> Column:
        """A branch up to bin ``t``."""
        return F.struct(t["bin"].alias("bin"), *[(s[c] + t[c]).alias(c) for c in ("bad", "weight", "of")])

    def step(so_far: Column, s: Column) -> Column:
        now = so_far["now"]
        return F.when(
            _apart(now["bad"], now["weight"], s["bad"], s["weight"], similar),
            F.struct(F.array_append(so_far["done"], now).alias("done"), s.alias("now")),
        ).otherwise(F.struct(so_far["done"].alias("done"), joined(now, s).alias("now")))

    none = F.array().cast("array<struct<bin:int,bad:double,weight:double,of:bigint>>")
    branches = F.aggregate(
        F.slice("bins", F.lit(2), F.size("bins")),
        F.struct(none.alias("done"), F.get("bins", F.lit(0)).alias("now")),
        step,
        lambda end: F.array_append(end["done"], end["now"]),
    )
    lists = lists.select("host", "template", branches.alias("branches"))
    # A child's branch is the first that does not end before its bin.
    number = F.size(F.filter("branches", lambda b: b["bin"] < F.col("bin")))
    own = F.get("branches", number)
    return children.join(lists, ["host", "template"]).select(
        *children.drop("weight", "bin").columns,
        number.alias("branch"),
        own["bad"].alias("branch_bad"),
        own["weight"].alias("branch_weight"),
        own["of"].alias("branch_of"),
        F.size("branches").alias("branches"),
    )


def judge_urls(
    pages: DataFrame,
    rules: dict[str, str],
    id_col: str = "page_id",
    url_col: str = "url",
    bad_words: tuple[str, ...] = BAD_WORDS,
    label_col: str | None = None,
    cut: Cut | None = None,
) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) of every row of ``pages``.

    ``rules`` map a host and path prefix to ``block`` or ``allow``; the longest that fits gives the verdict.
    Other urls are judged by their template: ``block`` if its smoothed share of bad urls (``purity``)
    reaches REJECT.  Urls that a rule blocks are bad and those it allows good; of the others those are bad or
    good that ``label_col`` (a boolean column of ``pages``, say of what a classifier makes of their text) calls
    so, then hosts with a bad word in their name are bad, and the rest are unlabelled.

    Null urls and those without ``://`` have an empty host and path and one template of their own.  Null
    ids are carried; rows that repeat count and are judged each; no rows give no rows; other columns of
    ``pages`` are not looked at.
    """
    cut = cut or table_cut(pages.sparkSession)
    host, path = host_and_path(pages[url_col])
    label = F.lit(None) if label_col is None else pages[label_col]
    urls = pages.select(pages[id_col].alias("id"), host.alias("host"), path.alias("path"), label.cast("boolean").alias("label"))
    rule, given = longest_rule(F.col("host"), F.col("path"), rules)
    named = F.arrays_overlap(F.split("host", r"[.\-]"), F.array(*map(F.lit, bad_words)).cast("array<string>"))
    bad = F.when(given == "block", 1.0).when(given == "allow", 0.0)
    bad = bad.when(F.col("label"), 1.0).when(~F.col("label"), 0.0).when(named, 1.0)
    urls = urls.select("id", "host", "path", rule.alias("rule"), given.alias("given"), bad.alias("bad"), segments(F.col("path")).alias("parts"))

    tree = cut(
        urls.groupBy("host", "parts").agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("bad"), F.lit(0.0)).alias("bad"),
            F.count("bad").alias("labelled"),
        ),
        "shapes",
    )
    judged_columns = ["host", "parts", "template", "purity"]
    sums = [F.sum(c).alias(c) for c in ("n", "bad", "labelled")]

    # Level 0: hosts.
    hosts = tree.groupBy("host").agg(*sums)
    hosts = hosts.select(
        F.col("host").alias("of"),
        ((F.col("bad") + PRIOR * ROOT) / (_weight() + PRIOR)).alias("purity"),
    )
    tree = tree.join(hosts, F.col("host") == F.col("of")).withColumn("template", F.lit("")).drop("of")
    longest = tree.select("parts").agg(F.max(F.size("parts"))).first()[0] or 0
    finished = []
    for level in range(longest):
        part = F.get("parts", F.lit(level))
        # Paths that end above this level stay where they are.
        tree = cut(tree.withColumn("part", part), f"level_{level}")
        # Children can differ only if shares of shapes do, and z squared is at most their weight; other nodes are final.
        share = F.col("bad") / _weight()
        kinds = tree.where("part is not null").groupBy("host", "template").agg(
            F.min(share).alias("low"), F.max(share).alias("high"), F.sum(_weight()).alias("weight")
        )
        kinds = kinds.where((F.col("low") < F.col("high")) & (F.col("weight") >= SIMILAR**2))
        differ = cut(kinds.select("host", "template"), f"differ_{level}")
        if differ.isEmpty():
            break
        finished.append(tree.join(differ, ["host", "template"], "left_anti").select(*judged_columns))
        tree = tree.join(differ, ["host", "template"], "left_semi")
        children = tree.where("part is not null").groupBy("host", "template", "part").agg(*sums, F.first("purity").alias("above"))
        smooth = (F.col("branch_bad") + PRIOR * F.col("above")) / (F.col("branch_weight") + PRIOR)
        # A segment holds no slash, so a wildcard that begins with one is like none.
        wild = F.when(F.col("branches") == 1, "/*").otherwise(F.concat(F.lit("/*"), F.col("branch").cast("string")))
        name = F.when(F.col("branch_of") == 1, F.col("part")).otherwise(wild)
        nodes = _branched(children, SIMILAR).select(
            "host",
            "template",
            "part",
            name.alias("child"),
            F.when(F.col("branches") > 1, smooth).otherwise(F.col("above")).alias("node_purity"),
        )
        tree = tree.join(nodes, ["host", "template", "part"], "left").select(
            "host",
            "parts",
            "n",
            "bad",
            "labelled",
            F.coalesce("node_purity", "purity").alias("purity"),
            F.concat("template", F.when(F.col("child").isNull(), "").otherwise(F.concat(F.lit("/"), "child"))).alias("template"),
        )
    judged = cut(reduce(DataFrame.union, finished, tree.select(*judged_columns)), "templates")
    return urls.join(judged, ["host", "parts"]).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("given", F.when(F.col("purity") >= REJECT, "block").otherwise("allow")).alias("verdict"),
        "template",
        "purity",
    )
