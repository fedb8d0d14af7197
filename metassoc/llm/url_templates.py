"""Operator 10: URL filter by rules and by a path-template tree (DataFrame functions only).

Paths are cut into segments.  Numbers, long hexadecimal strings and UUIDs become wildcards at once (a file extension stays).
Then the tree of every host is walked from its root down, from one branching to the next whatever the depth: a segment below a
template becomes a wildcard where its parent has many children and the segment has only a small part of the parent's pages.
All work is done on distinct paths with counts.

Pages that a rule decides are the labels.  From the first branchings down, statistically similar siblings are merged
into one branch ``~``, whose children are then compared together.  Siblings with the same most frequent child form a pool.  A branch is similar if

* its pages fall on its children as those of the pool do (chi-square test),
* its share of blocked labels does not differ from that of the pool (z-test) or, if it has no labels, its number of pages does
  not differ from the mean of the labelled branches (Poisson test): so an unlabelled branch can join labelled ones.

A template is rejected if it has enough labelled pages and its smoothed purity (blocked + 1) / (labelled + 2)
reaches a threshold; a page without a rule gets its template's verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metassoc.llm.common import staged
from metassoc.session import prepare


@dataclass(frozen=True)
class Rule:
    verdict: str         # allow or block
    host: str            # lower case; fits the host and its subdomains
    path: str            # prefix of the path

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
MANY_CHILDREN = 16       # a parent with more children than this has variable segments
SMALL_SHARE = 0.02       # of the parent's pages: a child with less is variable
Z = 1.96                 # two-sided 5 % level of the merging tests
MIN_LABELLED = 5         # labelled pages that a template needs to be rejected
REJECT = 0.8             # smoothed purity from which it is rejected

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VARIABLE = r"^(?:\d+|[0-9a-fA-F]{12,}|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})(\.[A-Za-z0-9]{1,5})?$"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; from there up to ``?``,
    ``#`` or the end.  Both empty for a null url or one without ``://``."""
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2147483647))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits (of equally long ones the first by name), else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name])):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """Non-empty segments, plain variables as ``*``."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, VARIABLE, r"*$1"))


def _common(lo: Column, hi: Column) -> Column:
    """Length of the common beginning of two arrays."""
    n = F.least(F.size(lo), F.size(hi))
    same = F.zip_with(F.slice(lo, F.lit(1), n), F.slice(hi, F.lit(1), n), lambda a, b: a == b)
    first = F.array_position(same, False)
    return F.when(first > 0, first.cast("int") - 1).otherwise(n)


def generalise(paths: DataFrame, many: int = MANY_CHILDREN, small: float = SMALL_SHARE) -> DataFrame:
    """(host, segs, n, labelled, blocked, template, cuts) of distinct (host, segs, n, labelled, blocked): the tree's wildcards, and the
    places in the template where the tree branches.

    A round takes every node to its next branching: what all paths below a node begin with (the common beginning of the
    least and the greatest of them) is passed at once, so that long chains cost nothing."""
    rest = F.slice("segs", F.col("at") + 1, F.greatest(F.size("segs") - F.col("at"), F.lit(0)))
    columns = ["host", "segs", "n", "labelled", "blocked", "template", "cuts", "at"]
    now = paths.select("host", "segs", "n", "labelled", "blocked", F.array().cast("array<string>").alias("template"),
                       F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("at"))
    done = None
    while True:
        walked = now.withColumn("rest", rest)
        node = walked.groupBy("host", "template").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi")).select(
            "host", "template", _common(F.col("lo"), F.col("hi")).alias("skip"))
        walked = staged(walked.join(node, ["host", "template"]).select(
            "host", "segs", "n", "labelled", "blocked", F.concat("template", F.slice("rest", F.lit(1), F.col("skip"))).alias("template"),
            "cuts", (F.col("at") + F.col("skip")).alias("at")), "walked")
        ended = walked.where(F.size("segs") <= F.col("at"))
        done = ended if done is None else done.union(ended)
        going = walked.where(F.size("segs") > F.col("at")).withColumn("seg", F.get("segs", F.col("at")))
        if going.isEmpty():
            return done.drop("at")
        child = going.groupBy("host", "template", "seg").agg(F.sum("n").alias("c"))
        parent = child.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("c").alias("total"))
        variable = child.join(parent, ["host", "template"]).where(
            (F.col("children") > many) & (F.col("c") < F.col("total") * small) & ~F.startswith("seg", F.lit("*"))).select(
            "host", "template", "seg", F.lit(True).alias("v"))
        next_seg = F.when(F.col("v"), F.lit("*")).otherwise(F.col("seg"))
        now = staged(going.join(variable, ["host", "template", "seg"], "left").select(
            "host", "segs", "n", "labelled", "blocked", F.concat("template", F.array(next_seg)).alias("template"),
            F.concat("cuts", F.array("at")).alias("cuts"), (F.col("at") + 1).alias("at")), "templates").select(*columns)


def merge_branches(tree: DataFrame, z: float = Z) -> DataFrame:
    """(host, template, branch, labelled, blocked) of (host, template, cuts, n, labelled, blocked): every template with the merged branch
    that it belongs to and that branch's labels."""
    now = tree.withColumn("branch", F.col("template"))
    rounds = tree.agg(F.max(F.size("cuts"))).first()[0] or 0
    for r in range(1, rounds + 1):
        place = F.get("cuts", F.lit(r - 1))
        # a branch is a prefix that ends at this branching; what lies below it goes with it
        at = now.where(F.size("cuts") >= r).select(
            "host", F.slice("branch", F.lit(1), place).alias("up"), F.get("branch", place).alias("seg"),
            F.coalesce(F.get("template", place + 1), F.lit("")).alias("child"), "n", "labelled", "blocked")
        cells = at.groupBy("host", "up", "seg", "child").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")])
        side = cells.groupBy("host", "up", "seg").agg(F.sum("n").alias("pages"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"),
                                                      F.max_by("child", F.struct("n", "child")).alias("kind"))
        side = staged(side, "siblings")
        shared = cells.select("host", "up", "seg", "child", "n").join(side.select("host", "up", "seg", "kind", "pages"), ["host", "up", "seg"])
        expected = shared.groupBy("host", "up", "kind", "child").agg(F.sum("n").alias("e"))
        pool = side.groupBy("host", "up", "kind").agg(
            F.count("*").alias("k"), F.sum("pages").alias("all"), F.sum("l").alias("pl"), F.sum("b").alias("pb"),
            F.sum(F.when(F.col("l") > 0, F.col("pages"))).alias("lp"), F.sum((F.col("l") > 0).cast("long")).alias("lk"))
        kinds = expected.groupBy("host", "up", "kind").agg((F.count("*") - 1).cast("double").alias("free"))
        fit = (shared.join(expected, ["host", "up", "kind", "child"]).join(pool.select("host", "up", "kind", "all"), ["host", "up", "kind"])
               .groupBy("host", "up", "seg").agg((F.sum(F.col("n") * F.col("n") / (F.col("pages") * F.col("e") / F.col("all"))) - F.max("pages")).alias("chi")))
        found = side.join(pool, ["host", "up", "kind"]).join(kinds, ["host", "up", "kind"]).join(fit, ["host", "up", "seg"]).where("k > 1 AND pl > 0")
        # chi-square as a normal deviate (Wilson and Hilferty)
        width = F.lit(2.0) / (F.col("free") * 9)
        shape = (F.col("free") == 0) | ((F.cbrt(F.greatest("chi", F.lit(0.0)) / F.col("free")) - 1 + width) <= z * F.sqrt(width))
        p = F.col("pb") / F.col("pl")
        said = F.abs(F.col("b") / F.col("l") - p) <= z * F.sqrt(p * (1 - p) / F.col("l"))
        mean = F.col("lp") / F.col("lk")
        sized = F.abs(F.col("pages") - mean) <= z * F.sqrt(F.col("pages") + mean)
        alike = staged(found.where(shape & F.when(F.col("l") > 0, said).otherwise(sized)).select(
            "host", "up", "seg", "kind", F.lit(True).alias("same")), "alike")
        names = alike.groupBy("host", "up").agg(F.count_distinct("kind").alias("pools"))
        # pools below one parent that each merge are told apart by their kind of child
        alike = alike.join(names, ["host", "up"]).select(
            "host", "up", "seg", F.when(F.col("pools") > 1, F.concat(F.lit("~"), "kind")).otherwise(F.lit("~")).alias("merged"))
        keyed = now.withColumn("up", F.when(F.size("cuts") >= r, F.slice("branch", F.lit(1), place))).withColumn(
            "seg", F.when(F.size("cuts") >= r, F.get("branch", place)))
        now = staged(keyed.join(alike, ["host", "up", "seg"], "left").withColumn("branch", F.when(F.col("merged").isNotNull(), F.concat(
            "up", F.array("merged"), F.slice("branch", place + 2, F.size("branch")))).otherwise(F.col("branch")))
            .select("host", "template", "cuts", "n", "labelled", "blocked", "branch"), "branches")
    sums = now.groupBy("host", "branch").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    return now.select("host", "template", "branch").join(sums, ["host", "branch"])


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES,
          min_labelled: int = MIN_LABELLED, reject: float = REJECT) -> DataFrame:
    """(id_col, host, path, rule, verdict, template, purity) for every row.

    rule: name of the longest rule that fits, else null.  verdict: the rule's, else block for a rejected template, else
    allow.  template: the page's merged branch as a path; purity: its smoothed share of blocked labels (0.5 without any).
    A null url or one without ``://`` has empty host and path and is allowed unless a template of that host is rejected.
    Repeated rows and null ids are kept; other columns are not read; an empty table gives no rows."""
    prepare(df.sparkSession)
    host, path = split_url(F.col("u"))
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("u")).select("id", host.alias("host"), path.alias("path"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    pages = pages.select("id", "host", "path", name.alias("rule"), verdict.alias("said"), segments(F.col("path")).alias("segs"))
    label = F.col("said").isNotNull().cast("long")
    paths = staged(pages.groupBy("host", "segs").agg(F.count("*").alias("n"), F.sum(label).alias("labelled"),
                                                     F.sum((F.col("said") == "block").cast("long")).alias("blocked")), "paths")
    paths = paths.withColumn("blocked", F.coalesce("blocked", F.lit(0).cast("long")))
    templates = staged(generalise(paths), "templates")
    tree = staged(templates.groupBy("host", "template").agg(
        F.first("cuts").alias("cuts"), *[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]), "tree")
    branches = merge_branches(tree)
    purity = (F.col("blocked") + 1) / (F.col("labelled") + 2)
    known = staged(templates.select("host", "segs", "template").join(branches, ["host", "template"]).select(
        "host", "segs", F.concat(F.lit("/"), F.array_join("branch", "/")).alias("template"), purity.alias("purity"),
        ((F.col("labelled") >= min_labelled) & (purity >= reject)).alias("rejected")), "known")
    found = pages.join(known, ["host", "segs"], "left")
    return found.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("said", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                        "template", "purity")
