"""Merkle manifest of a dataset, held together by nested leaf-rank intervals.

Every row is a leaf; leaves are ranked inside their tree (the distinct values of
one column) and up to ``fanout`` consecutive nodes have one parent, until one
node is left. A node carries the interval ``[lo, hi)`` of leaf ranks it covers,
and nothing else ties the levels together: intervals of one level are bucketed
by the width of that level, and a containment join of a bucket attaches parents
to their children. What the parent's interval has besides the child's own are
the child's siblings, left and right of it. The trees' roots are the leaves of a
tree over the trees.

Leaves are ranked by a range partitioning, a level is one aggregate with at most
``fanout`` rows a group, and proofs go down level by level, so that each leaf meets
just its parent; texts are read once and never shuffled. Levels are stage tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.ranking import global_offsets

from .common import skew_join, stage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "array<struct<left: string, right: string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (lower-case hex) of the fields one after the other: ``-`` for a null, else byte count, ``:``, value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and its siblings of each level lead to; null without a leaf or a proof."""
    return F.aggregate(proof, leaf, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def interval_levels(leaves: DataFrame, fanout: int = FANOUT, name: str = "merkle") -> list[DataFrame]:
    """The levels above ``leaves`` ``(tree, rank, size, digest)``, lowest first: ``tree, lo, hi, size, digest, kids``.

    ``size`` is the number of leaves of the tree, ``kids`` the children's intervals and digests in order.
    """
    levels, width = [], 1
    below = leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "size", "digest")
    while True:
        growing = below.where(F.col("size") > width)
        if not growing.limit(1).count():
            return levels
        width *= fanout
        node = growing.groupBy("tree", "size", F.floor(F.col("lo") / width).alias("_bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        digest = F.sha2(F.array_join(F.col("kids.digest"), ""), 256)
        below = stage(node.select("tree", F.element_at("kids", 1)["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                                  "size", digest.alias("digest"), "kids"), f"{name}-level-{len(levels) + 1}")
        levels.append(below)


def _with_parents(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """Each node with its parent's proof in front of which its own siblings stand, in ``proof``, and its tree's top digest.

    ``nodes`` have ``tree, lo, hi``; ``parents`` (intervals ``width`` wide) have ``kids``, ``proof`` and ``subroot``.
    """
    p = parents.select(F.col("tree").alias("_tree"), F.floor(F.col("lo") / width).alias("_bucket"), F.col("lo").alias("_lo"),
                       F.col("hi").alias("_hi"), F.col("kids").alias("_kids"), "proof", "subroot")
    inside = ((F.col("tree") == F.col("_tree")) & (F.floor(F.col("lo") / width) == F.col("_bucket"))
              & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
    j = nodes.join(p, inside)
    digests = lambda some: F.array_join(F.transform(some, lambda k: k["digest"]), "")
    left = digests(F.filter("_kids", lambda k: k["hi"] <= F.col("lo")))
    right = digests(F.filter("_kids", lambda k: k["lo"] >= F.col("hi")))
    own = F.array(F.struct(left.alias("left"), right.alias("right")))
    return j.select(*[nodes[c] for c in nodes.columns], F.concat(own, F.col("proof")).alias("proof"), "subroot")


def _proven(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int, name: str) -> DataFrame:
    """``leaves`` with ``proof`` and ``subroot``; ``tops`` has each tree's ``tree, proof, subroot`` (of the tree's top node)."""
    above = None
    for i in range(len(levels), 0, -1):
        level, width = levels[i - 1], fanout ** i
        top = level.where(F.col("size") <= width).join(tops, "tree")
        if above is None:
            done = top
        else:
            done = top.unionByName(_with_parents(level.where(F.col("size") > width), above, width * fanout))
        above = stage(done.select("tree", "lo", "hi", "kids", "proof", "subroot"), f"{name}-proof-{i}")
    alone = leaves.where("size = 1").join(tops, "tree")
    if above is None:
        return alone
    return alone.unionByName(_with_parents(leaves.where("size > 1"), above, fanout))


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", tree_col: str = "lang",
                    fanout: int = FANOUT, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``tree_col``, ``rank`` (in its tree), leaf, subroot, root, proof and ``carry``.

    ``proof`` lists the levels from the leaf to the root, each with the digests
    ``left`` and ``right`` of the node's siblings one after the other (empty
    strings: none). Leaves of a tree ascend by ``id_col`` (null first), those of one id by their
    digest; trees ascend by ``tree_col`` (null, a tree of its own, first). Equal rows are
    leaves of their own. ``carry`` adds columns computed from the input row. Columns that
    are not ``fields`` do not enter; an empty table has no rows and no root.
    """
    if fanout < 2:
        raise ValueError("a node has two children at least")
    spark, carry = docs.sparkSession, carry or {}
    extra = [c.alias(f"_carry_{n}") for n, c in carry.items()]
    leaves = stage(docs.select(F.col(id_col).alias("_id"), F.col(tree_col).isNotNull().alias("_some"),
                               F.coalesce(F.col(tree_col).cast("string"), F.lit("")).alias("_key"),
                               leaf_digest([F.col(f"`{c}`") for c in fields]).alias("digest"), *extra), "merkle-leaves")
    placed = global_offsets(leaves, ["_some", "_key", "_id", "digest"], out_col="_at")
    per_tree = stage(leaves.groupBy("_some", "_key").agg(F.count(F.lit(1)).alias("size")), "merkle-trees")
    numbers = global_offsets(per_tree, ["_some", "_key"], size_col="size", out_col="_first")
    per_tree = stage(global_offsets(numbers, ["_some", "_key"], out_col="tree"), "merkle-tree-places")
    placed = stage(skew_join(placed, per_tree, ["_some", "_key"], "size").withColumn("rank", F.col("_at") - F.col("_first"))
                   .drop("_at", "_first").withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1}), "merkle-ranked")

    levels = interval_levels(placed, fanout)
    # the trees' roots, each in the tree over the trees
    roots = placed.where("size = 1").select("tree", "digest")
    for i, level in enumerate(levels, 1):
        roots = roots.unionByName(level.where(F.col("size") <= fanout ** i).select("tree", "digest"))
    many = per_tree.count()
    roots = stage(roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.lit(many).cast("long").alias("size"), "digest",
                               F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi")), "merkle-roots")
    upper = interval_levels(roots, fanout, "merkle-top")
    root = (upper[-1] if upper else roots).select(F.col("tree"), F.col("digest").alias("subroot"), F.array().cast(_PROOF).alias("proof"))
    tops = _proven(roots, upper, root, fanout, "merkle-top").select(
        F.col("lo").alias("tree"), "proof", F.struct(F.col("digest").alias("subroot"), F.col("subroot").alias("root")).alias("subroot"))
    out = _proven(placed, levels, stage(tops, "merkle-tops"), fanout, "merkle")
    key = F.when(F.col("_some"), F.col("_key")).cast(docs.schema[tree_col].dataType)
    return out.select(F.col("_id").alias(id_col), key.alias(tree_col), "rank", F.col("digest").alias("leaf"), "subroot.subroot", "subroot.root",
                      "proof", *[F.col(f"_carry_{n}").alias(n) for n in carry])
