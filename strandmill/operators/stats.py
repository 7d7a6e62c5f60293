"""Read-length statistics, coverage cutoff and the assembly report.

Lengths enter as a histogram (``rl, count``): its rows are bounded by the longest read, whatever the number of reads, so
the global windows below run over a small table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def length_histogram(reads: DataFrame, length: Column) -> DataFrame:
    return reads.select(length.cast("long").alias("rl")).groupBy("rl").agg(F.count(F.lit(1)).alias("count"))


def _longest_first(histogram: DataFrame) -> DataFrame:
    w = W.orderBy(F.col("rl").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    return histogram.withColumn("bases", F.sum(F.col("rl") * F.col("count")).over(w))


def coverage_cutoff(histogram: DataFrame, target: int) -> DataFrame:
    """One row ``cutoff``: the largest length such that reads at least as long hold ``target`` bases; too large a target raises."""
    found = _longest_first(histogram).agg(F.max(F.when(F.col("bases") >= target, F.col("rl"))).alias("cutoff"), F.max("bases").alias("total"))
    lacking = F.raise_error(F.concat(F.lit(f"Not enough reads available for desired genome coverage (bases needed={target} > actual="), F.coalesce(F.col("total"), F.lit(0)).cast("string"), F.lit(")")))
    return found.select(F.when(F.col("cutoff").isNull(), lacking.cast("long")).otherwise(F.col("cutoff")).alias("cutoff"))


def read_stats(histogram: DataFrame, percentile: float = 0.95) -> DataFrame:
    """One row ``nreads, total, n50, p95, esize``.

    n50 is the length at which the longest reads first hold half of the bases, rounded down; p95 the element at index
    int(n * 0.95) of the ascending lengths; esize the mean length of the read that a random base lies in.
    """
    ascending = W.orderBy("rl").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy()
    rows = (
        _longest_first(histogram)
        .withColumn("upto", F.sum("count").over(ascending))
        .withColumn("nreads", F.sum("count").over(whole))
        .withColumn("total", F.sum(F.col("rl") * F.col("count")).over(whole))
    )
    return rows.agg(
        F.max("nreads").alias("nreads"),
        F.max("total").alias("total"),
        F.max(F.when(F.col("bases") >= F.floor(F.col("total") * 0.5), F.col("rl"))).alias("n50"),
        F.min(F.when(F.col("upto") > F.floor(F.col("nreads") * percentile), F.col("rl"))).alias("p95"),
        (F.sum(F.col("rl") * F.col("rl") * F.col("count").cast("decimal(20,0)")).cast("double") / F.max("total")).alias("esize"),
    )


def cutoff_reads(histogram: DataFrame, cutoff: int) -> DataFrame:
    return histogram.filter(F.col("rl") >= cutoff)


def weighted_average(rows: DataFrame, value: str, weight: str) -> DataFrame:
    return rows.agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("average"))


def fragmentation(pieces: DataFrame, seed: str) -> DataFrame:
    """Mean number of corrected pieces per seed, by counts of counts."""
    counts = pieces.groupBy(seed).agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("seeds"))
    return weighted_average(counts, "n", "seeds").withColumnRenamed("average", "fragmentation")


def average_difference(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Mean over ``a`` of a - b by key; a key that ``b`` lacks raises."""
    other = b.select(F.col(key).alias("o_key"), F.col(value).alias("o_value"))
    met = a.join(other, F.col(key) == F.col("o_key"), "left")
    gap = F.when(F.col("o_key").isNull(), F.raise_error(F.concat(F.lit("no value for key "), F.col(key).cast("string"))).cast("double"))
    return met.select(gap.otherwise(F.col(value) - F.col("o_value")).alias("difference")).agg(F.avg("difference").alias("average"))


def truncation(corrected: DataFrame, raw: DataFrame, key: str, value: str) -> DataFrame:
    """Bases that a seed loses on average: the negated mean difference of summed corrected pieces to raw lengths."""
    summed = corrected.groupBy(key).agg(F.sum(value).alias(value))
    return average_difference(summed, raw, key, value).select((-F.col("average")).alias("truncation"))


def assembly_report(raw: DataFrame, seeds: DataFrame, corrected: DataFrame, genome_length: int | None, length_cutoff: int | None, fragmentation: float = -1.0, truncation: float = -1.0) -> DataFrame:
    """One row of 26 metrics from three histograms; floats rounded to 3 places. No genome length counts as -1."""
    genome = genome_length or -1
    parts = []
    for name, histogram in (("raw", raw), ("seed", seeds), ("preassembled", corrected)):
        s = read_stats(histogram)
        parts.append(
            s.select(
                F.lit(1).alias(f"k_{name}"),
                F.col("nreads").alias(f"{name}_reads"),
                F.col("total").alias(f"{name}_bases"),
                F.round(F.col("total") / F.col("nreads"), 3).alias(f"{name}_mean"),
                F.col("n50").alias(f"{name}_n50"),
                F.col("p95").alias(f"{name}_p95"),
                F.round(F.col("total") / F.lit(genome), 3).alias(f"{name}_coverage"),
                F.round("esize", 3).alias(f"{name}_esize"),
            )
        )
    row = parts[0].join(parts[1], F.col("k_raw") == F.col("k_seed")).join(parts[2], F.col("k_raw") == F.col("k_preassembled"))
    return (
        row.withColumn("genome_length", F.lit(genome))
        .withColumn("length_cutoff", F.lit(length_cutoff or 0))
        .withColumn("preassembled_yield", F.round(F.col("preassembled_bases") / F.col("seed_bases"), 3))
        .withColumn("preassembled_seed_fragmentation", F.lit(round(fragmentation, 3)))
        .withColumn("preassembled_seed_truncation", F.lit(round(truncation, 3)))
        .drop("k_raw", "k_seed", "k_preassembled")
    )


def report_json(report: DataFrame) -> str:
    """The one-row report as JSON text with sorted keys."""
    return json.dumps(report.first().asDict(), sort_keys=True, indent=4, separators=(",", ": "))
