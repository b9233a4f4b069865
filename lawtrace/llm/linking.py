"""From bucket members to verified links and connected groups, without pairing all members of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.storage import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (a, b): the smallest node of its connected group.

    Labels fall to the smallest of the neighbours' and then jump to their label's label, so long chains shorten by
    half in each round; every round is a written table, and only a count comes to the driver.
    """
    own = Scratch(edges.sparkSession)
    both = own.written(edges.select("a", "b").union(edges.select("b", "a")), "edges")
    labels = own.written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = own.written(labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")), "step")
        jumped = own.written(step.join(step.selectExpr("node as label", "label as next"), "label").select("node", "was", F.least("label", "next").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> was").isEmpty():
            break
    labels = scratch.written(labels, "labels")
    own.drop()
    return labels


def joined_groups(labels: DataFrame, more: DataFrame, scratch: Scratch) -> DataFrame:
    """``labels`` of ``components`` after ``more`` edges (a, b): groups, not nodes, are connected, so many edges between two groups are one."""
    own = Scratch(labels.sparkSession)
    of = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"l{s}"))
    between = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    groups = components(own.written(between.where("a <> b").distinct(), "between"), own)
    known = labels.join(groups.select(F.col("node").alias("label"), F.col("label").alias("low")), "label", "left").select("node", F.coalesce("low", "label").alias("label"))
    # nodes without a label before are groups of one
    fresh = groups.join(labels, "node", "left_anti").select("node", "label")
    out = scratch.written(known.unionByName(fresh), "labels")
    own.drop()
    return out


def linked(nodes: DataFrame, traits_of: Callable[[DataFrame], DataFrame], verified: Callable[[DataFrame], DataFrame], plausible: Callable[[str, str], str], scratch: Scratch, spent: Scratch | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``(links, labels)`` of the nodes that share a key and pass ``verified``; labels is None if no pair holds.

    nodes: a stored table (node, keys array of long). First every node of a bucket meets only the bucket's most
    central node: the one with the most company in all its buckets, as an original has among its copies. Nodes that this
    connects need no further pair among themselves; where a bucket still holds several groups, its pairs across groups
    are verified, so no connection that a bucket offers is lost, and a bucket of n copies of one text costs n pairs and
    not n squared. A pair of several common keys is made in the bucket of the least of them alone. ``verified`` gets
    distinct pairs (a, b), a < b, and returns those that hold.

    ``spent``, if given, holds the table of nodes and goes when its shared keys are found, which takes less disk: then a node's list of keys
    does not travel with it into the pairs across groups, and those of several common keys are made distinct afterwards.

    ``traits_of`` gets the nodes (node) that share a key with another and returns them with small columns, the traits;
    ``plausible("a_", "b_")`` is SQL over the traits, prefixed, that holds for every pair that can pass. It is a condition of
    the joins, so implausible pairs never become rows. Bucket sizes are aggregated before the shuffle, and members meet
    their bucket in sort-merge joins of two plain inputs, which adaptive execution splits where a key is hot.
    """
    early, own, last = Scratch(scratch.spark), Scratch(scratch.spark), Scratch(scratch.spark)
    keys = ["keys"] if spent is None else []
    members = nodes.select("node", F.explode("keys").alias("key"))
    shared = early.written(members.groupBy("key").agg(F.count("*").alias("company")).where("company > 1"), "shared")
    crowd = early.written(members.join(shared.hint("merge"), "key"), "crowd")
    degrees = early.written(crowd.groupBy("node").agg(F.sum("company").alias("degree")), "degrees")
    if spent is not None:
        spent.drop()
    light = own.written(traits_of(degrees.select("node")), "traits")
    # the largest degree, then the smallest node, as one number would not hold both
    best = F.max(F.struct("degree", (-F.col("node")).alias("low")))
    pivots = early.written(crowd.join(degrees, "node").groupBy("key").agg(best.alias("best")).select("key", (-F.col("best.low")).alias("pivot")), "pivots")
    star = crowd.join(pivots, "key").where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    columns = [c for c in light.columns if c != "node"]

    def of(side: str) -> DataFrame:
        return light.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])

    tested = own.written(star.join(of("a"), "a").join(of("b"), "b").where(plausible("a_", "b_")).select("a", "b"), "star")
    links = scratch.written(verified(tested), "links")
    labels = None if links.isEmpty() else components(links, scratch)
    grouped = crowd.select("key", "node", F.col("node").alias("label")) if labels is None else crowd.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    grouped = own.written(grouped, "grouped")
    early.drop()
    several = own.written(grouped.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key"), "several")
    mixed = grouped.join(several, "key").join(light, "node")
    mixed = own.written(mixed.join(nodes.select("node", "keys"), "node") if keys else mixed, "mixed")

    def side(s: str) -> DataFrame:
        return mixed.select("key", F.col("node").alias(s), F.col("label").alias(f"l{s}"), *[F.col(c).alias(f"{s}_{c}") for c in [*columns, *keys]])

    across = side("a").join(side("b"), "key").where(f"a < b and la <> lb and ({plausible('a_', 'b_')})")
    across = across.where("array_min(array_intersect(a_keys, b_keys)) = key").select("a", "b") if keys else across.select("a", "b").distinct()
    rest = last.written(across.join(tested, ["a", "b"], "left_anti"), "across")
    own.drop()
    if not rest.isEmpty():
        more = scratch.written(verified(rest), "links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(more, scratch) if labels is None else joined_groups(labels, more, scratch)
    last.drop()
    return links, labels
