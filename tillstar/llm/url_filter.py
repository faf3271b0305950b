"""URL filters by a sort-merge range join: which rule fits a URL best.

A rule is a host and the start of a path; it fits its host and all subdomains. The canonical key of
a rule is its host's labels in reverse, then the path, so that the keys it fits form an interval:
all keys that begin with it. A URL asks with one key for each of its host's suffixes that can be a
rule's host. Openings and endings of the intervals and the keys asked for are sorted together, in
range partitions. Intervals are nested or apart, so in a sweep along the order they form a stack,
whose depth is a running sum, and the rule on top at a key is the last one opened at that depth.
Partitions are swept side by side: each starts with the stack that those before it leave.

Only DataFrame functions are used; rules are never broadcast, so there may be any number of them.

Defined results: a null url, or one without "://", has empty host and path; A to Z in the host become
lower case, the path stays as it is; no fitting rule means rule null and the default verdict; of
rules with the same host and path, block wins; rules without host or path are ignored; of several
fitting rules the longest text wins, then the longer host; repeated rows are judged each by
itself; other columns are carried along.
"""

import string

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.llm.common import written

DEFAULT = "allow"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Order of what has the same key: endings, openings, questions.
_CLOSE, _OPEN, _ASK = 0, 1, 2


def lower_ascii(text):
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url):
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path_of(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _labels(host):
    return F.reverse(F.split(host, r"\."))


def _key(labels, path):
    """Labels cannot hold "/" nor paths "?", so each key says where its labels and its host end."""
    return F.concat(F.array_join(labels, "/"), F.lit("?"), path).cast("binary")


def _rule_events(rules):
    """An opening and an ending for each rule; no text has the byte FF, so it ends the interval."""
    given = rules.select(lower_ascii("host").alias("host"), "path", "verdict").dropna(subset=["host", "path"])
    one = given.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.struct(
        F.length(F.concat("host", "path")).alias("length"),
        F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"),
        F.coalesce("verdict", F.lit("block")).alias("verdict"),
    )
    start = _key(_labels("host"), F.col("path"))
    ends = F.array(
        F.struct(start.alias("key"), F.lit(_OPEN).alias("kind"), F.lit(1).alias("step")),
        F.struct(F.concat(start, F.lit(b"\xff")).alias("key"), F.lit(_CLOSE).alias("kind"), F.lit(-1).alias("step")),
    )
    return one.select(rule.alias("rule"), F.explode(ends).alias("e")).select("e.*", "rule")


def judge(df, rules, url="url", default=DEFAULT):
    """The rows of df with host, path, rule and verdict.

    rules: columns host, path and verdict (allow or block).
    """
    opened = _rule_events(rules)
    most_labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.monotonically_increasing_id().alias("id"),
    )
    labels = _labels("host")
    suffixes = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels)))
    # The first question carries the row, the others its number only.
    asked = rows.select("id", "row", "host", "path", labels.alias("labels"), F.explode(suffixes).alias("n")).select(
        _key(F.slice("labels", 1, F.col("n")), F.col("path")).alias("key"),
        F.lit(_ASK).alias("kind"),
        F.lit(0).alias("step"),
        "id",
        F.when(F.col("n") == 1, F.struct("row", "host", "path")).alias("page"),
    )
    order = ["key", "kind", "id"]
    events = opened.unionByName(asked, allowMissingColumns=True).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = events.drop("key").withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    answered = _swept(written(placed, "events"))
    best = answered.groupBy("id").agg(F.max("rule").alias("rule"), F.first("page", ignorenulls=True).alias("page"))
    taken = {"host", "path", "rule", "verdict"}
    return best.select(
        *[F.col(f"page.row.`{c}`").alias(c) for c in df.columns if c not in taken],
        "page.host",
        "page.path",
        "rule.rule",
        F.coalesce("rule.verdict", F.lit(default)).alias("verdict"),
    )


def _swept(events):
    """The questions of the placed events with the rule on top of the stack at their place."""
    parts = events.groupBy("part").agg(F.sum("step").alias("step"))
    # One row per partition: how many rules are open where it starts.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("step").over(earlier), F.lit(0)).alias("open"))
    along = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    deep = events.join(F.broadcast(starts), "part").withColumn("depth", F.col("open") + F.sum("step").over(along))
    kept = deep.filter(F.col("kind") != _CLOSE).select("part", "at", "kind", "depth", "rule", "id", "page")
    # The stack at a partition's start: at each depth, the last rule opened there before.
    last = kept.filter(F.col("kind") == _OPEN).groupBy("part", "depth").agg(F.max_by("rule", "at").alias("rule"))
    depths = F.explode(F.sequence(F.lit(1).cast("long"), "open"))
    wanted = starts.filter("open > 0").select("part", depths.alias("depth"))
    before = Window.partitionBy("depth").orderBy("part", "asks").rowsBetween(Window.unboundedPreceding, 0)
    stack = (
        last.withColumn("asks", F.lit(1))
        .unionByName(wanted.withColumn("asks", F.lit(0)), allowMissingColumns=True)
        .withColumn("rule", F.last("rule", ignorenulls=True).over(before))
        .filter("asks = 0")
        .select("part", "depth", "rule", F.lit(-1).cast("long").alias("at"), F.lit(_OPEN).alias("kind"))
    )
    at_depth = Window.partitionBy("part", "depth").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("kind") == _OPEN, F.col("rule")), ignorenulls=True).over(at_depth)
    met = kept.unionByName(stack, allowMissingColumns=True).withColumn("rule", top)
    return met.filter(F.col("kind") == _ASK)
