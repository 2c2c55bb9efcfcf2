"""Connected components of similar items: banded candidates, verified links, union-find in rounds.

Only small tables of numbers pass here: buckets, links and parents. Nothing is
collected; each round is a few joins and tables in the shared folder, deleted when their last reader is done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import Scratch


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of the links (a, b); root is the smallest node it hangs together with.

    Distributed union-find: in each round every node hooks to its smallest
    neighbour if that is smaller, parents are followed, and the links are
    rewritten to the parents. Links within one tree vanish; the rounds end when
    none is left. Loops and repeated links do no harm. Tables of the rounds are deleted at the end.
    """
    return _components(Scratch(links.sparkSession), links, "roots")


def _components(scratch: Scratch, links: DataFrame, label: str) -> DataFrame:
    """The one table that is left is `label` of the scratch."""
    live = scratch.put(_ordered(links.select("a", "b")), "live-0")
    found, k = live.select(F.col("a").alias("node"), F.col("b").alias("root")), 0
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("node"), F.least("a", "p").alias("p"))
        up = hooks.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        parents = scratch.put(hooks.join(up, "p").select("node", F.col("pp").alias("parent")), f"parents-{k}")
        of_a, of_b = (parents.select(F.col("node").alias(c), F.col("parent").alias("p" + c)) for c in "ab")
        moved = live.join(of_a, "a").join(of_b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        live = scratch.put(_ordered(moved), f"live-{k + 1}")
        scratch.drop(f"live-{k}")
        # All nodes have a parent in the first round; those that are still linked have one in the next.
        if k:
            found = found.join(parents.select(F.col("node").alias("root"), "parent"), "root", "left")
            found = found.select("node", F.coalesce("parent", "root").alias("root"))
        else:
            found = parents.select("node", F.col("parent").alias("root"))
        k += 1
    found = scratch.put(found, "found")
    scratch.drop(f"live-{k}", *[f"parents-{i}" for i in range(k)])
    scratch.rename("found", label)
    return found


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(
    members: DataFrame,
    similar: Callable[[DataFrame], DataFrame],
    weighed: Callable[[DataFrame], DataFrame],
    least: float,
    small: int = 0,
    told: DataFrame | None = None,
    able: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(node, root) and the verified links (a, b) of all that share a bucket and are similar.

    members: bucket, node (distinct). similar: takes pairs a, b and returns those
    with a Jaccard similarity of at least `least`. weighed: takes nodes and
    returns node, shingle, weight, the sets that are compared.

    Pairs are not made within whole buckets of more than `small` nodes. First each bucket is a star around
    its smallest node. In the buckets that then still lie in several components the
    star is drawn again around the node whose shingles are shared most, which
    is what many copies have been made from. Last, nodes of different components are
    compared as far as they can be similar (see `_possible`). In smaller buckets all
    pairs of different components are compared after the first star, which is cheaper; with `told`, what
    is known of each node beside it, only those that are `able` by their columns of sides _a and _b are made. A pair within one
    component could add no connection, so the components are those of all candidate pairs.
    """
    scratch = Scratch(members.sparkSession)
    span = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    stars = members.join(span.select("bucket", "low"), "bucket")
    shared = scratch.put(stars, "stars")
    links = scratch.put(similar(_ordered(shared.select(F.col("low").alias("a"), F.col("node").alias("b")))), "links-of-stars")
    roots = _components(scratch, links, "roots-of-stars")
    shared = _apart(scratch, shared.select("bucket", "node"), roots, "apart")
    scratch.drop("stars")
    if small:
        sized = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
        few = shared.join(sized.where(F.col("size").between(3, small)).select("bucket"), "bucket")
        few = few if told is None else few.join(told, "node")
        sides = [c for c in few.columns if c != "bucket"]
        left, right = (few.select("bucket", *[F.col(c).alias(c + n) for c in sides]) for n in ("_a", "_b"))
        apart = F.expr("node_a < node_b AND root_a != root_b")
        pairs = left.join(right, "bucket").where(apart if able is None else apart & able)
        pairs = _ordered(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
        links = links.union(scratch.put(similar(pairs), "links-of-pairs"))
        scratch.drop("roots-of-stars")
        roots = _components(scratch, links, "roots-of-pairs")
        # Of two nodes in a bucket the star has compared all pairs.
        many = shared.select("bucket", "node").join(sized.where(F.col("size") > small).select("bucket"), "bucket", "left_semi")
        shared = _apart(scratch, many, roots, "apart-by-pairs")
        scratch.drop("apart")
    last = "apart-by-pairs" if small else "apart"
    if shared.isEmpty():
        scratch.drop(last)
        return roots, links
    scratch.drop("roots-of-pairs" if small else "roots-of-stars")
    prefixes, centrality = _ranked(weighed(shared.select("node").distinct()), least, scratch)
    central = shared.join(centrality, "node")
    centre = central.groupBy("bucket").agg(F.max_by("node", F.struct("shared", "node")).alias("centre"))
    star = shared.join(centre, "bucket").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    links = links.union(scratch.put(similar(_ordered(star)), "links-of-centres"))
    scratch.drop(last)
    roots = _components(scratch, links, "roots-of-centres")
    placed = prefixes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = scratch.put(placed, "prefixes")
    scratch.drop("ranked", "roots-of-centres")
    links = links.union(scratch.put(similar(_ordered(_possible(placed, least))), "links-of-prefixes"))
    scratch.drop("prefixes")
    return _components(scratch, links, "roots"), links


def _ranked(sets: DataFrame, least: float, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """Of each set the shingles a similar set must share one of, and how much is shared at all.

    Shingles are put in one order for all sets, rarest first. Two sets with a
    similarity of at least `least` share a shingle before which lies at most 1 - least of
    either set's weight. First result: node, shingle, size, before (the weight of the
    node's shingles up to this one), for those that occur in several sets. Of other
    shingles only the first of each set is written, beside how much the set shares; `ranked` of the scratch is left.
    """
    scratch = scratch or Scratch(sets.sparkSession)
    sets = scratch.put(sets, "sets")
    often = sets.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("node").orderBy("n", "shingle")
    before = F.coalesce(F.sum("weight").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    whole = Window.partitionBy("node")
    size = F.sum("weight").over(whole)
    shared = F.sum(F.col("weight") * F.log("n")).over(whole) / size
    counted = sets.join(often, "shingle").withColumns({"before": before, "size": size, "shared": shared, "place": F.row_number().over(along)})
    early = (F.col("before") <= (1 - least) * F.col("size") + 1e-9) & (F.col("n") > 1)
    counted = scratch.put(counted.where(early | (F.col("place") == 1)).drop("weight"), "ranked")
    scratch.drop("sets")
    return counted.where(early).select("node", "shingle", "before", "size"), counted.where("place = 1").select("node", "shared")


def _possible(prefixes: DataFrame, least: float) -> DataFrame:
    """Pairs a, b of different roots that can be similar.

    At the first shingle two sets share, in the common order, what lies before
    it in either is not in the other. So they have at most the smaller of the rests in
    common; where that is too little for both sizes, no pair is made.
    """
    left, right = (prefixes.select("shingle", *[F.col(c).alias(c + n) for c in ("node", "root", "before", "size")]) for n in ("_a", "_b"))
    rest = F.least(F.col("size_a") - F.col("before_a"), F.col("size_b") - F.col("before_b"))
    able = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    able &= rest * (1 + least) >= least * (F.col("size_a") + F.col("size_b")) - 1e-6
    return left.join(right, "shingle").where(able).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _apart(scratch: Scratch, shared: DataFrame, roots: DataFrame, label: str) -> DataFrame:
    """The buckets whose nodes lie in several components, with the root of each node."""
    placed = shared.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    several = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y")
    return scratch.put(placed.join(several.select("bucket"), "bucket", "left_semi"), label)
