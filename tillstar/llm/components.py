"""Connected components of a graph given as a table of links."""

from pyspark.sql import functions as F

from tillstar.llm.common import attached, written


def connected_components(links):
    """Each linked node with its component's smallest node: (node, component).

    links: columns a and b, node numbers. In each round every node joins the neighbour, or itself,
    that comes first in an order drawn anew per round; two such steps are taken at once, and the
    links between the merged nodes go on. The number of nodes falls by a constant share a round,
    however long a chain is. Minima are taken map-side, so a node with very many links is no
    burden; each round is written, so a lost executor costs tasks only.

    Nulls and loops are ignored; nodes without links do not appear.
    """
    left = written(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    steps = []
    while not left.isEmpty():
        turn = F.lit(len(steps))
        both = left.union(left.select("b", "a"))
        first = F.min(F.struct(F.xxhash64("b", turn).alias("h"), F.col("b").alias("to")))
        own = F.struct(F.xxhash64("a", turn).alias("h"), F.col("a").alias("to"))
        chosen = both.groupBy("a").agg(first.alias("best")).select("a", F.least("best", own)["to"].alias("to"))
        further = chosen.select(F.col("a").alias("to"), F.col("to").alias("next"))
        merged = written(chosen.join(further, "to").select("a", F.col("next").alias("to")), "merged")
        steps.append(merged)
        ends = merged.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        moved = left.join(merged, "a").join(ends, "b").filter("to <> to_b")
        left = written(
            moved.select(F.least("to", "to_b").alias("a"), F.greatest("to", "to_b").alias("b")).distinct(), "links"
        )
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    placed = steps[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for step in steps[1:]:
        moves = step.select(F.col("a").alias("root"), F.col("to").alias("new_root"))
        placed = placed.join(moves, "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
    placed = written(placed, "roots")
    least = placed.groupBy("root").agg(F.least(F.min("node"), F.col("root")).alias("component"), F.count(F.lit(1)).alias("n"))
    return attached(placed, written(least, "components"), "root", "n").select("node", "component")
