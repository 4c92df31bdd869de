"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a fixed 60-bit key from its id. A source that must give r words beyond whole passes over its
documents gives those whose key lies under a threshold. The threshold comes from a histogram of words by source and
leading bits of the key: the running sum finds the bucket in which the budget runs out, and only that bucket is cut
finer in the next round. Nothing is sorted, and thresholds are nested: a larger budget only adds documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rrnlake.llm.common import staged, word_count
from rrnlake.plans.durable import durable
from rrnlake.plans.ordering import dense_index

KEY_BITS = 60
BROADCAST_SOURCES = 100_000  # rows of a name and four numbers; more are joined by a shuffle


@dataclass(frozen=True)
class MixRules:
    """weights repeat over the sources in code point order, null last; max_passes bounds how often a document is taken;
    level_bits is the width of one histogram (4096 buckets per source by default)."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.0
    max_passes: int = 3
    level_bits: int = 12


def document_key(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id as text, so that reruns and other engines agree; a null id counts as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """Add `weight` and `target` to (source, source_size).

    A target is level * weight, or max_passes * source_size where that is less; the level is raised until the targets
    add up to the budget. Each round is one aggregate over the sources, and a source once full stays full.
    """
    ranked = dense_index(sizes, [F.col("source").asc_nulls_last()], "_rank")
    turn = (F.col("_rank") - 1) % len(rules.weights)
    weights = F.array(*[F.lit(float(w)) for w in rules.weights])
    ranked = durable(ranked.withColumn("weight", F.get(weights, turn.cast("int"))).drop("_rank"))
    room = F.col("source_size") * F.lit(float(rules.max_passes))
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * rules.share
    level, full = -1.0, 0.0
    while True:
        is_full = room < F.lit(level) * F.col("weight")
        given, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(is_full, room)), F.lit(0.0)), F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0))
        ).first()
        if level >= 0 and given == full:
            break
        full = given
        if not open_weight:
            break
        level = (budget - given) / open_weight
    return ranked.withColumn("target", F.least(room, F.lit(max(level, 0.0)) * F.col("weight")))


def _thresholds(rows: DataFrame, targets: DataFrame, rules: MixRules) -> DataFrame:
    """Per source: whole passes and `cut`, the key below which documents are taken once more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    passes = F.least(whole, F.lit(rules.max_passes)).cast("long")
    state = durable(
        targets.withColumn("passes", passes)
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumns({"prefix": F.lit(0).cast("long"), "before": F.lit(0).cast("long"), "inside": F.col("source_size"),
                      "n": F.lit(2).cast("long")})
    )
    used = 0
    while used < KEY_BITS:
        step = min(rules.level_bits, KEY_BITS - used)
        left = KEY_BITS - used - step
        near = state.filter("n > 1").select(F.col("source").alias("_s"), F.col("prefix").alias("_p"))
        hist = (
            rows.join(near, rows["source"].eqNullSafe(near["_s"]) & (F.shiftright("key", left + step) == F.col("_p")))
            .groupBy("source", F.shiftright("key", left).alias("_b"))
            .agg(F.sum("size").alias("_words"), F.count("*").alias("_n"))
        )
        # At most 2 ** level_bits rows of a source.
        run = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (
            hist.withColumn("_upto", F.sum("_words").over(run))
            .join(state.select(F.col("source").alias("_s"), F.col("before").alias("_low"), F.col("rest").alias("_r")),
                  F.col("source").eqNullSafe(F.col("_s")))
            .filter("_low + _upto > _r")
            .groupBy("_s")
            .agg(F.min(F.struct("_b", "_words", (F.col("_low") + F.col("_upto") - F.col("_words")).alias("_before"), "_n")).alias("_hit"))
        )
        old = state.drop("_s")
        # A source without a hit is taken whole: its prefix moves behind the last bucket.
        fresh = old.join(found, old["source"].eqNullSafe(found["_s"]), "left").select(
            "source", "source_size", "weight", "target", "passes", "rest",
            F.when(F.col("n") <= 1, F.shiftleft("prefix", step)).otherwise(
                F.coalesce("_hit._b", F.shiftleft(F.col("prefix") + 1, step))).alias("prefix"),
            F.coalesce("_hit._before", "before").alias("before"),
            F.coalesce("_hit._words", F.when(F.col("n") <= 1, F.col("inside")).otherwise(F.lit(0))).alias("inside"),
            F.when(F.col("n") <= 1, F.col("n")).otherwise(F.coalesce("_hit._n", F.lit(0))).alias("n"),
        )
        state = durable(fresh)
        used += step
        if not state.filter("n > 1").limit(1).count():
            break
    over = F.col("before") + F.col("inside") - F.col("rest")
    extra = F.when((F.col("n") > 0) & (over < F.col("rest") - F.col("before")), F.lit(1)).otherwise(F.lit(0))
    return state.withColumn("cut", F.shiftleft(F.col("prefix") + extra, KEY_BITS - used))


def _cuts(docs: DataFrame, rules: MixRules) -> tuple[DataFrame, DataFrame]:
    """The narrow rows of docs, and per source its target and thresholds, broadcast when counted to be few."""
    rows = staged(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), document_key(F.col("doc_id")).alias("key")), "mix"
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = durable(_thresholds(rows, source_targets(sizes, rules), rules).select(
        F.col("source").alias("__source"), "source_size", "target", "passes", "cut"))
    return rows, F.broadcast(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts


def mix_sources(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every document.

    size is the number of words (null text: 0), taken is size times how often the mix takes the document. Sources are
    told apart by value, null being one of them; a source of no words has target 0. Documents with the same id share
    their key and are taken alike. An empty table gives no rows. Other columns of docs are ignored. Runs jobs.
    """
    rows, cuts = _cuts(docs, rules)
    times = F.col("passes") + (F.col("key") < F.col("cut")).cast("long")
    return rows.join(cuts, rows["source"].eqNullSafe(cuts["__source"])).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def apply_mix(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The rows of docs, with all their columns, as often as the mix takes them (see mix_sources). Runs jobs."""
    _, cuts = _cuts(docs, rules)
    cuts = cuts.select("__source", F.col("passes").alias("__passes"), F.col("cut").alias("__cut"))
    times = F.col("__passes") + (document_key(F.col("doc_id")) < F.col("__cut")).cast("long")
    joined = docs.join(cuts, docs["source"].eqNullSafe(cuts["__source"]))
    # array_repeat of no elements explodes to no row.
    return joined.withColumn("__again", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*[docs[c] for c in docs.columns])
