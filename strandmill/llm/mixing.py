"""Mixing sources to target weights, by Sainte-Lague apportionment of equal-size word blocks.

1. Targets: sources share ``budget`` times all words by weight; none may pass ``max_repeats`` times its own
   size, and what it can't take is shared again by weight. The fixed point has one water level, found with a
   running sum over the sources (one row per source).
2. Blocks of ``block`` words are dealt to sources by the highest quotients target / (2 s + 1), and each
   source's blocks to its shards in the same way, by their words. Whole-number quotas come from rounding;
   only the last few quotients, as many as there are sources (or shards), are ranked.
3. Every shard lays its documents end to end in a seeded order and takes whole passes, then a circular run of
   blocks from a seeded first block. A document takes the words of its stretch that were selected.

A shard is (source, hash of doc_id); there are as many hashes as keep a shard near ``SHARD_ROWS`` rows, so a source with a third of
all rows is spread over many windows, whatever its size. All of it is DataFrame expressions.

Defined results: null or blank texts have size 0 and take 0; very long texts are counted whole; null source is a source of its own, the last;
repeated rows are documents of their own; a corpus without words has targets of 0; other columns, whatever their names, are
ignored or passed through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.llm.rowkeys import fresh_name, with_row_key
from strandmill.session import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARD_ROWS = 1 << 11


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """``source, source_size`` -> the same with ``weight`` and ``target`` (double)."""
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_repeats)
    # Sources by the water level at which they are full. Up to the first that isn't full, all are.
    by_level = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    from_here = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    filled = (
        ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(budget)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(from_here))
        .withColumn("full", F.col("left") * F.col("weight") >= F.col("cap") * F.col("open_weight"))
    )
    first_open = F.min(F.when(~F.col("full"), F.struct("rank_by_level", "left", "open_weight"))).over(everything)
    leveled = filled.withColumn("rank_by_level", F.row_number().over(by_level)).withColumn("at", first_open)
    target = F.when(F.col("at").isNull() | (F.col("rank_by_level") < F.col("at.rank_by_level")), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("at.left") / F.col("at.open_weight")
    )
    return leveled.select("source", "source_size", "weight", target.cast("double").alias("target"))


def sainte_lague(items: DataFrame, group: list[str], item: list[str], share: str, seats: str) -> DataFrame:
    """Adds ``quota``: the group's ``seats`` dealt to its items by the highest quotients share / (2 s + 1).

    Rounding share * seats / total gives all but a few seats: with k items the sum is off by d <= k/2, and an
    item's quota by at most (d + k) * share / total + 1, so ranking that many quotients of each item
    is exact. Ties go to the smaller item.
    """
    whole = W.partitionBy(*group).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum(share).over(whole)
    part = F.when(total > 0, F.col(share) / total).otherwise(F.lit(0.0))
    base = (
        items.withColumn("part", part)
        .withColumn("base", F.floor(F.col("part") * F.col(seats) + 0.5).cast("long"))
        .withColumn("short", F.when(total > 0, F.col(seats)).otherwise(0) - F.sum("base").over(whole))
        .withColumn("k", F.count(F.lit(1)).over(whole))
    )
    tries = F.ceil((F.abs("short") + F.col("k")) * F.col("part")).cast("int") + 1
    step = F.when(F.col("short") > 0, F.col("base") + F.col("j")).otherwise(F.col("base") - 1 - F.col("j"))
    quotients = (
        base.filter((F.col("short") != 0) & (F.col(share) > 0))
        .select(*group, *item, "short", "base", share, F.explode(F.sequence(F.lit(0), tries - 1)).alias("j"))
        .withColumn("step", step)
        .filter(F.col("step") >= 0)
        .withColumn("quotient", F.col(share) / (2 * F.col("step") + 1))
    )
    better = F.when(F.col("short") > 0, F.col("quotient")).otherwise(-F.col("quotient"))
    order = W.partitionBy(*group).orderBy(better.desc(), *item, "j")
    moved = (
        quotients.withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= F.abs("short"))
        .groupBy(*group, *item)
        .agg(F.sum(F.signum("short")).cast("long").alias("moved"))
    )
    keys = [*group, *item]
    left, right = base.alias("l"), moved.select(*[F.col(c).alias(f"r_{c}") for c in keys], "moved")
    on = F.lit(True)
    for c in keys:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r_{c}"))
    joined = left.join(right, on, "left")
    quota = F.col("base") + F.coalesce("moved", F.lit(0))
    return joined.select(*[F.col(f"l.{c}").alias(c) for c in items.columns], quota.alias("quota"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = 1.5,
    max_repeats: int = 2,
    block: int = 16,
    shard_rows: int = SHARD_ROWS,
    seed: int = 42,
    row: Column | None = None,
) -> DataFrame:
    """Per document ``doc_id, row, source, size, source_size, target, quota_words, taken``; ``row`` tells rows apart, if given."""
    sized = settle(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            (F.lit(None).cast("long") if row is None else row).alias("row"),
            docs["source"].alias("source"),
            word_count(docs["text"]).alias("size"),
        )
    )
    shards = max(1, -(-sized.count() // shard_rows))
    sized = sized.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(shards)).cast("int"))
    shard_sizes = sized.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.count(F.lit(1)).alias("shard_docs"))
    sources = shard_sizes.groupBy("source").agg(F.sum("shard_size").alias("source_size"))
    seated = source_targets(sources, weights, budget, max_repeats)
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    seated = seated.withColumn("all_blocks", F.floor(F.sum("target").over(everything) / block + 0.5).cast("long"))
    quotas = sainte_lague(seated, [], ["source"], "target", "all_blocks").select(
        F.col("source").alias("s_source"), "source_size", "target", F.col("quota").alias("source_blocks")
    )
    per_shard = shard_sizes.join(quotas, F.col("source").eqNullSafe(F.col("s_source")), "left").drop("s_source")
    per_shard = settle(sainte_lague(per_shard, ["source"], ["shard"], "shard_size", "source_blocks"))

    k_source, k_shard = F.coalesce("source", F.lit("")), F.col("shard")
    keyed = sized.withColumn("no_source", F.col("source").isNull()).withColumn("k_source", k_source)
    limits = per_shard.select(
        F.col("source").isNull().alias("no_source"), k_source.alias("k_source"), k_shard.alias("shard"), "source_size", "target", "shard_size", (F.col("quota") * block).alias("quota_words")
    )
    joined = keyed.join(limits, ["no_source", "k_source", "shard"], "left")
    order = W.partitionBy("no_source", "k_source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size", "row")
    end = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    words = F.least(F.col("quota_words"), F.col("shard_size") * max_repeats)
    n_blocks = F.greatest(F.ceil(F.col("shard_size") / block).cast("long"), F.lit(1))
    first = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), n_blocks) * block
    laid = (
        joined.withColumn("end", end)
        .withColumn("begin", F.col("end") - F.col("size"))
        .withColumn("words", words)
        .withColumn("passes", F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.greatest("shard_size", F.lit(1)))).otherwise(0))
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("shard_size"))
        .withColumn("first", first)
    )

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.least(F.col("end"), high) - F.greatest(F.col("begin"), low), F.lit(0))

    stop = F.col("first") + F.col("rest")
    picked = overlap(F.col("first"), F.least(stop, F.col("shard_size"))) + overlap(F.lit(0), stop - F.col("shard_size"))
    taken = F.col("passes") * F.col("size") + picked
    return laid.select("doc_id", "row", "source", "size", "source_size", "target", "quota_words", taken.cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mixed corpus: every document whole, as often as half its words or more were taken (0 to 2 times).

    Only the documents at either end of a shard's run are taken in part, so whole documents keep the sources near their targets.
    Copies go by a row's own key, so null and repeated ids are no matter. Documents without words go.
    """
    keyed, key = with_row_key(docs)
    copies, copy = fresh_name(keyed, "copies"), fresh_name(keyed, "copy")
    mixed = mix_sources(keyed, row=keyed[key], **parameters).filter(F.col("taken") > 0)
    times = mixed.select(F.col("row").alias(key), F.round(F.col("taken") / F.col("size")).cast("int").alias(copies)).filter(F.col(copies) > 0)
    repeated = keyed.join(times, key).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*docs.columns)
