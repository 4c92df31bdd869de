"""Cluster taxonomy: representative, lowest common ancestor, majority; taxid lineages.

The consensus operators start from `cluster_lineages`, which folds all members
of a cluster to its distinct lineages with counts, as numbers; a cluster with a
third of all members is folded on the map side. Its rows lie together by cluster,
so that what follows moves no lineage text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rrnlake.config import GTDB, RANK_NAMES, TaxonomySystem
from rrnlake.functions.lineage import SEP, cut_below, split_ranks, strip_strain, unite_ranks
from rrnlake.plans.durable import durable, written
from rrnlake.plans.sizing import broadcast_if_small

RANKS = [r.lower() for r in RANK_NAMES]
UNKNOWN = "Unknown"
_TIE_BITS = 20  # low bits that count the values of one number of members


def lineage_ranks(lineage: DataFrame, system: TaxonomySystem = GTDB) -> DataFrame:
    """Split the lineage column to one column per rank and keep the text."""
    return lineage.select("*", *split_ranks(F.col("lineage"), system))


def cluster_members(records: DataFrame, operons: DataFrame) -> DataFrame:
    """Centroids and hits with their assembly: (cluster_id, operon_id, is_centroid, assembly)."""
    return (
        records.filter(F.col("rec_type").isin("S", "H"))
        .select("cluster_id", F.col("query").alias("operon_id"), (F.col("rec_type") == "S").alias("is_centroid"))
        .join(operons.select("operon_id", "assembly"), "operon_id", "left")
        .select("cluster_id", "operon_id", "is_centroid", "assembly")
    )


def cluster_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("cluster_id").agg(F.count("*").alias("size"))


def tax_full(operons: DataFrame, lineage: DataFrame) -> DataFrame:
    """Lineage of every operon by its assembly."""
    return operons.join(lineage.select("assembly", "lineage"), "assembly", "left").select("operon_id", "lineage")


def tax_rep(members: DataFrame, lineage: DataFrame) -> DataFrame:
    """Lineage of each cluster's centroid, without strain."""
    centroids = members.filter("is_centroid")
    return centroids.join(broadcast_if_small(lineage.select("assembly", "lineage")), "assembly", "left").select(
        "cluster_id", "operon_id", strip_strain(F.col("lineage")).alias("lineage")
    )


def cluster_lineages(
    members: DataFrame, lineage: DataFrame, system: TaxonomySystem = GTDB, parts: int | None = None
) -> DataFrame:
    """Distinct member lineages per cluster with member counts (cluster_id, kingdom..species, n), in `parts` by cluster."""
    ranked = lineage_ranks(lineage, system).select("assembly", *RANKS)
    # Numbers stand for the distinct lineages while members move; no number stands for no rank at all.
    known = ranked.select(*RANKS).distinct().filter(F.coalesce(*RANKS).isNotNull())
    numbered = written(known.withColumn("_lineage", F.monotonically_increasing_id()), "lineages")
    same = reduce(Column.__and__, [F.col(f"l.{r}").eqNullSafe(F.col(f"r.{r}")) for r in RANKS])
    coded = written(ranked.alias("l").join(numbered.alias("r"), same, "left").select("assembly", "_lineage"), "assembly-lineages")
    small = broadcast_if_small(coded)
    if small is coded:  # the join shuffles: each (cluster, assembly) once
        ones = members.groupBy("cluster_id", "assembly").agg(F.count("*").alias("n"))
    else:
        ones = members.select("cluster_id", "assembly", F.lit(1).cast("bigint").alias("n"))
    counted = ones.join(small, "assembly", "left").groupBy("cluster_id", "_lineage").agg(F.sum("n").alias("n"))
    names = broadcast_if_small(numbered)
    # A cluster has at most as many rows here as there are lineages.
    placed = counted if names is numbered else counted.repartition(*([parts] if parts else []), "cluster_id")
    return placed.join(names, "_lineage", "left").select("cluster_id", *RANKS, "n")


def _agrees(rank: str) -> Column:
    """One distinct value in the group, where NULL is a value."""
    value = F.col(rank)
    missing = F.sum(value.isNull().cast("int"))
    return ((missing == 0) & (F.min(value) == F.max(value))) | (missing == F.count("*"))


def lca_levels(lineages: DataFrame) -> DataFrame:
    """Deepest rank number on which a cluster agrees (7 = species, 0 = none).

    Ranks are tested on their own: agreement at a rank does not ask for
    agreement above it. One aggregate covers all ranks.
    """
    tests = lineages.groupBy("cluster_id").agg(*[_agrees(r).alias(f"same_{r}") for r in RANKS])
    level = F.coalesce(*[F.when(F.col(f"same_{r}"), F.lit(i + 1)) for i, r in reversed(list(enumerate(RANKS)))], F.lit(0))
    return tests.select("cluster_id", level.alias("level"))


def rank_name(level: Column) -> Column:
    names = [F.when(level == i + 1, r) for i, r in enumerate(RANK_NAMES)]
    return F.coalesce(*names, F.lit(UNKNOWN))


def tax_lca(
    lineages: DataFrame, levels: DataFrame, centroids: DataFrame, drop_unknown: bool = False
) -> DataFrame:
    """Lineages of each cluster cut at its agreed rank: (cluster_id, operon_id, lca_rank, lineage).

    A cluster that agrees on a rank but not above it has several rows. Clusters
    without any agreement are Unknown, or left out with drop_unknown.
    """
    kept = levels.filter(F.col("level") > 0) if drop_unknown else levels
    masked = [
        F.when(F.col("level") >= i + 1, F.coalesce(F.col(r), F.lit("NA"))).otherwise("NA").alias(r)
        for i, r in enumerate(RANKS)
    ]
    rows = lineages.join(kept, "cluster_id").select("cluster_id", "level", *masked).distinct()
    owner = centroids.select("cluster_id", "operon_id")
    return rows.join(owner, "cluster_id", "left").select(
        "cluster_id", "operon_id", rank_name(F.col("level")).alias("lca_rank"),
        unite_ranks([F.col(r) for r in RANKS]).alias("lineage"),
    )


def conflicting_species(lineages: DataFrame, levels: DataFrame) -> DataFrame:
    """Members per species in clusters that do not agree on the species."""
    open_clusters = levels.filter(F.col("level") < len(RANKS))
    return (
        lineages.join(open_clusters, "cluster_id", "left_semi")
        .groupBy("cluster_id", "species")
        .agg(F.sum("n").alias("operon_count"))
    )


def maj_levels(lineages: DataFrame) -> DataFrame:
    """Deepest rank number with a single most common value (0 = none).

    All ranks go through one unpivot. The mode is unique when one value only has
    the highest count. A cluster of one lineage has one value at each rank.
    """
    rows = lineages.withColumn("_rows", F.count("*").over(Window.partitionBy("cluster_id")))
    ranks = F.when(F.col("_rows") > 1, F.array(*RANKS)).otherwise(F.array(RANKS[-1]))
    deepest = F.when(F.col("_rows") > 1, 0).otherwise(len(RANKS) - 1)
    stacked = rows.select("cluster_id", "n", deepest.alias("_from"), F.posexplode(ranks).alias("_pos", "value"))
    counts = stacked.groupBy("cluster_id", (F.col("_from") + F.col("_pos")).alias("pos"), "value").agg(F.sum("n").alias("n"))
    # Values by count, the highest count with its number of values in one long: no value is sorted.
    ties = counts.groupBy("cluster_id", "pos", "n").agg(F.count("*").alias("k"))
    high = F.max(F.shiftleft("n", _TIE_BITS) + F.least("k", F.lit((1 << _TIE_BITS) - 1)))
    modes = ties.groupBy("cluster_id", "pos").agg(high.alias("high"))
    unique = F.col("high").bitwiseAND((1 << _TIE_BITS) - 1) == 1
    return modes.groupBy("cluster_id").agg(
        F.coalesce(F.max(F.when(unique, F.col("pos") + 1)), F.lit(0)).alias("level")
    )


def tax_maj(
    levels: DataFrame, members: DataFrame, lineage: DataFrame, system: TaxonomySystem = GTDB
) -> DataFrame:
    """The centroid's own lineage cut at the majority rank of its cluster.

    Without a majority at any rank the cut is below the top rank.
    """
    texts = lineage_ranks(lineage, system).select("assembly", unite_ranks([F.col(r) for r in RANKS]).alias("_text"))
    text = F.coalesce("_text", F.lit(SEP.join(["NA"] * len(RANKS))))
    level = F.greatest(F.col("level"), F.lit(1))
    return (
        members.filter("is_centroid")
        .join(levels, "cluster_id")
        .join(broadcast_if_small(texts), "assembly", "left")
        .select("cluster_id", "operon_id", cut_below(text, level, system).alias("lineage"))
    )


def lca_rank_summary(lca: DataFrame) -> DataFrame:
    """Rows per agreed rank and their share in percent."""
    counts = lca.groupBy("lca_rank").agg(F.count("*").alias("n"))
    # At most eight rows here, so the window over all of them is small.
    share = 100 * F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percentage", share)


def maj_rank_summary(levels: DataFrame) -> DataFrame:
    """Clusters per majority rank, all seven ranks listed, share in percent."""
    row = levels.agg(
        *[F.count_if(F.col("level") == i + 1).alias(r) for i, r in enumerate(RANK_NAMES)]
    )
    counts = row.select(
        F.inline(F.array(*[F.struct(F.lit(r).alias("maj_rank"), F.col(r).alias("n")) for r in RANK_NAMES]))
    )
    return counts.withColumn("percentage", 100 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def tax_combined(rep: DataFrame, lca: DataFrame, maj: DataFrame) -> DataFrame:
    """The three schemes side by side per centroid."""
    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        # One key, so that sides that lie by cluster stay where they are; a range of one value is no key of a join.
        right = right.withColumnsRenamed({"cluster_id": "_c", "operon_id": "_o"})
        same = (F.col("cluster_id") == F.col("_c")) & (F.col("operon_id") >= F.col("_o")) & (F.col("operon_id") <= F.col("_o"))
        return left.join(right, same, "left").drop("_c", "_o")

    return beside(
        beside(rep.withColumnRenamed("lineage", "tax_rep"), lca.withColumnRenamed("lineage", "tax_lca")),
        maj.withColumnRenamed("lineage", "tax_maj"),
    ).select("cluster_id", "operon_id", "tax_rep", "lca_rank", "tax_lca", "tax_maj")


def complete_subset(combined: DataFrame, complete_operons: DataFrame) -> DataFrame:
    return combined.join(complete_operons.select("operon_id"), "operon_id", "left_semi")


def two_columns(combined: DataFrame, scheme: str) -> DataFrame:
    """(operon_id, lineage) of one scheme: tax_rep, tax_lca or tax_maj."""
    return combined.select("operon_id", F.col(scheme).alias("lineage"))


def current_taxids(taxids: DataFrame, merged: DataFrame) -> DataFrame:
    """Replace merged taxids by their new ones; rows without taxid go."""
    moved = merged.select(F.col("old_id").alias("taxid"), "new_id")
    return (
        taxids.filter(F.col("taxid").isNotNull())
        .join(moved, "taxid", "left")
        .withColumn("current_taxid", F.coalesce("new_id", "taxid"))
        .drop("new_id")
    )


def with_ancestors(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The nodes of wanted (tax_id) and all above them: a frontier goes up a step a round and never over a node twice.

    One round per level of the tree; a cycle ends as its nodes are seen. Only what is needed of a large tree is kept.
    """
    nodes = written(nodes, "tree-nodes")  # read in every round
    frontier = durable(wanted.select("tax_id").distinct())
    seen = []
    while not frontier.isEmpty():
        seen.append(durable(nodes.join(frontier, "tax_id", "left_semi")))
        above = seen[-1].select(F.col("parent_id").alias("tax_id")).distinct()
        frontier = durable(above.join(_all(seen).select("tax_id"), "tax_id", "left_anti"))
    return _all(seen) if seen else nodes.filter("false")


def node_paths(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """Path of every node from below the root down to itself, as (rank, name) structs.

    Pointer doubling: each round joins a node's path to the path of the node it
    points to, so depth d takes log2(d) joins. Finished nodes leave the loop. A
    node whose way up comes back to itself, or leads into such nodes, has a NULL path.
    """
    kind = "array<struct<tax_id:bigint,rank:string,name:string>>"
    named = nodes.join(names, "tax_id", "left")
    step = F.struct("tax_id", "rank", "name")
    root = F.col("parent_id") == F.col("tax_id")
    state = durable(
        named.select(
            "tax_id",
            F.when(root, F.array().cast(kind)).otherwise(F.array(step)).cast(kind).alias("path"),
            F.when(~root, F.col("parent_id")).alias("up"),
        )
    )
    done = []
    while True:
        finished = state.filter(F.col("up").isNull())
        active = state.filter(F.col("up").isNotNull())
        done.append(finished)
        if active.isEmpty():
            break
        above = _all(done, active).select(
            F.col("tax_id").alias("up"), F.col("path").alias("_upper"), F.col("up").alias("_next"), F.lit(True).alias("_there")
        )
        joined = active.join(above, "up", "left").withColumn(
            "path", F.concat(F.when(F.col("_there"), F.col("_upper")).otherwise(F.array().cast(kind)), "path"))
        loops = F.col("path").isNull() | F.coalesce(F.exists("path", lambda p: p["tax_id"] == F.col("_next")), F.lit(False))
        state = durable(joined.select(
            "tax_id", F.when(~loops, F.col("path")).alias("path"), F.when(~loops, F.col("_next")).alias("up")))
    plain = F.transform("path", lambda p: F.struct(p["rank"].alias("rank"), p["name"].alias("name")))
    return _all(done).select("tax_id", plain.alias("path"))


def _all(parts: list[DataFrame], *more: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [*parts, *more])


def lineage_resolve(
    taxids: DataFrame, nodes: DataFrame, names: DataFrame, merged: DataFrame, deleted: DataFrame | None = None
) -> DataFrame:
    """Rows with a taxid to their full lineage (path structs and ';' joined names), and how it was found (status).

    status: current, merged (found under its new id), deleted (in `deleted`, tax_id), unknown (in no table), or cycle (the
    tree leads back to the node). Only the first two have a path.
    """
    current = current_taxids(taxids, merged)
    needed = with_ancestors(nodes, current.select(F.col("current_taxid").alias("tax_id")))
    paths = node_paths(needed, names).select(F.col("tax_id").alias("current_taxid"), "path", F.lit(True).alias("_known"))
    found = current.join(paths, "current_taxid", "left")
    gone = F.lit(False)
    if deleted is not None:
        found = found.join(deleted.select(F.col("tax_id").alias("current_taxid"), F.lit(True).alias("_gone")).distinct(), "current_taxid", "left")
        gone = F.col("_gone").isNotNull()
    status = (
        F.when(F.col("path").isNotNull(), F.when(F.col("current_taxid") == F.col("taxid"), "current").otherwise("merged"))
        .when(F.col("_known"), "cycle").when(gone, "deleted").otherwise("unknown")
    )
    text = F.array_join(F.transform("path", lambda p: p["name"]), ";")
    return found.withColumns({"lineage": text, "status": status}).drop("_known", "_gone")


def lineage_format(resolved: DataFrame) -> DataFrame:
    """Resolved paths to prefixed lineages of eight ranks, k__ to t__; NULL for an unresolved taxid.

    t__ is the strain, or the subspecies where there is no strain.
    """
    # Rank of each lineage place, with the names a dump may use for it.
    places = (
        ("k", ("superkingdom", "domain")), ("p", ("phylum",)), ("c", ("class",)), ("o", ("order",)),
        ("f", ("family",)), ("g", ("genus",)), ("s", ("species",)), ("t", ("subspecies", "strain")),
    )

    def place(letter: str, ranks: tuple[str, ...]) -> Column:
        hits = F.filter("path", lambda p: p["rank"].isin(*ranks))
        name = F.coalesce(F.try_element_at(hits, F.lit(-1))["name"], F.lit(""))
        return F.concat(F.lit(f"{letter}__"), name)

    text = F.concat_ws(SEP, *[place(*p) for p in places])
    return resolved.withColumn("lineage", F.when(F.size("path") > 0, text))
