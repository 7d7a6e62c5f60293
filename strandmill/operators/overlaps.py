"""Overlap filtering: coverage per read end, containment, best overlaps per read end.

Tables have the columns of ``schema.OVERLAPS``. ``group_by`` holds further keys (such as the file a row came from) when a
read's rows must not be counted together across them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.session import settle


@dataclass(frozen=True)
class CoverageLimits:
    max_diff: int = 1000
    max_cov: int = 1000
    min_cov: int = 1
    min_len: int = 1
    min_identity: float = 90.0


def accepted(limits: CoverageLimits) -> Column:
    """Rows good enough to count."""
    return (F.col("identity") >= limits.min_identity) & (F.col("q_l") >= limits.min_len) & (F.col("t_l") >= limits.min_len)


def end_counts(overlaps: DataFrame, ok: Column, left: Column, right: Column, keys: Sequence[str]) -> DataFrame:
    """Per key the accepted rows at either end. A read whose rows are all rejected still has a row, with counts of 0."""
    return overlaps.groupBy(*keys).agg(F.count_if(ok & left).alias("n_5p"), F.count_if(ok & right).alias("n_3p"))


def coverage_fails(limits: CoverageLimits) -> Column:
    a, b = F.col("n_5p"), F.col("n_3p")
    return (F.abs(a - b) > limits.max_diff) | (F.greatest(a, b) > limits.max_cov) | (F.least(a, b) < limits.min_cov)


def at_5p() -> Column:
    return F.col("q_s") == 0


def at_3p() -> Column:
    return F.col("q_e") == F.col("q_l")


def ignored_reads(overlaps: DataFrame, limits: CoverageLimits = CoverageLimits(), group_by: Sequence[str] = ()) -> DataFrame:
    """``q_id`` of the reads whose coverage at their ends is uneven, too high or too low."""
    counts = end_counts(overlaps, accepted(limits), at_5p(), at_3p(), [*group_by, "q_id"])
    return counts.filter(coverage_fails(limits)).select("q_id").distinct()


def overlap_stats(overlaps: DataFrame, min_len: int, min_identity: float = 90.0) -> DataFrame:
    """``q_id, q_l, n_5p, n_3p`` of the reads with an accepted overlap at either end."""
    limits = CoverageLimits(min_len=min_len, min_identity=min_identity)
    ok = accepted(limits)
    counted = overlaps.groupBy("q_id").agg(
        F.max("q_l").alias("q_l"), F.count_if(ok & at_5p()).alias("n_5p"), F.count_if(ok & at_3p()).alias("n_3p")
    )
    return counted.filter("n_5p > 0 OR n_3p > 0")


def without_reads(overlaps: DataFrame, reads: DataFrame, read: str = "q_id") -> DataFrame:
    """Rows neither of whose reads is listed. Spark broadcasts the list only where its statistics show that it is small."""
    listed = reads.select(F.col(read).alias("x_id")).distinct()
    for side in ("q_id", "t_id"):
        overlaps = overlaps.join(listed, F.col(side) == F.col("x_id"), "left_anti")
    return overlaps


def contained_ids(overlaps: DataFrame) -> DataFrame:
    """``read_id`` of the reads that lie inside another read, by the rows' tags."""
    inner = F.when(F.col("tag") == "contained", F.col("q_id")).when(F.col("tag") == "contains", F.col("t_id"))
    return overlaps.select(inner.alias("read_id")).filter("read_id IS NOT NULL").distinct()


def contained_reads(overlaps: DataFrame, ignored: DataFrame, limits: CoverageLimits = CoverageLimits()) -> DataFrame:
    return contained_ids(without_reads(overlaps.filter(accepted(limits)), ignored))


def best_per_end(
    overlaps: DataFrame, bestn: int, keys: Sequence[str], end: str, order: Sequence[Column], m_range: Column, margin: int = 1000
) -> DataFrame:
    """Rows in order up to and with the first that is past ``bestn`` and leaves more than ``margin`` of its target uncovered."""
    w = W.partitionBy(*keys, end).orderBy(*order)
    nth = F.row_number().over(w) - 1
    stops = overlaps.withColumn("b_stop", F.when((nth >= bestn) & (m_range > margin), 1).otherwise(0))
    stopped = F.coalesce(F.sum("b_stop").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return stops.withColumn("b_stopped", stopped).filter("b_stopped = 0").drop("b_stop", "b_stopped")


def best_overlaps(
    overlaps: DataFrame, ignored: DataFrame, contained: DataFrame, bestn: int, limits: CoverageLimits = CoverageLimits(), group_by: Sequence[str] = ()
) -> DataFrame:
    """The best overlaps of each read end. A row that touches both ends counts for the 5' end."""
    listed = ignored.select("q_id").unionByName(contained.select(F.col("read_id").alias("q_id")))
    left = without_reads(overlaps.filter(accepted(limits)), listed)
    end = F.when(at_5p(), 0).when(at_3p(), 1)
    rows = left.withColumn("b_end", end).filter("b_end IS NOT NULL").withColumn("b_range", F.col("t_l") - (F.col("t_e") - F.col("t_s")))
    as_text = [F.col(c).cast("string") for c in overlaps.columns]
    kept = best_per_end(rows, bestn, [*group_by, "q_id"], "b_end", [F.col("score"), F.col("b_range"), *as_text], F.col("b_range"))
    return kept.drop("b_end", "b_range")


def filter_overlaps(overlaps: DataFrame, bestn: int = 10, limits: CoverageLimits = CoverageLimits(), group_by: Sequence[str] = ()) -> DataFrame:
    """All three stages: coverage, containment, best overlaps per end. The lists of reads are settled, so each is made once."""
    ignored = settle(ignored_reads(overlaps, limits, group_by))
    contained = settle(contained_reads(overlaps, ignored, limits))
    return best_overlaps(overlaps, ignored, contained, bestn, limits, group_by)


def graph_rows(overlaps: DataFrame, min_identity: float = 96.0, min_len: int = 4000) -> DataFrame:
    """Proper overlaps for the graph. Containment is judged before identity and length, on all rows but self-overlaps."""
    others = overlaps.filter("q_id <> t_id")
    contained = contained_ids(others)
    proper = others.filter(~F.col("tag").isin("contained", "contains", "none")).filter(
        (F.col("identity") >= min_identity) & (F.col("q_l") >= min_len) & (F.col("t_l") >= min_len)
    )
    return without_reads(proper, contained, "read_id")


def first_per_pair(rows: DataFrame, a: str, b: str, order: Sequence[Column]) -> DataFrame:
    """One row per unordered pair: the first in order."""
    w = W.partitionBy("p_low", "p_high").orderBy(*order)
    keyed = rows.withColumn("p_low", F.least(a, b)).withColumn("p_high", F.greatest(a, b))
    return keyed.withColumn("p_nth", F.row_number().over(w)).filter("p_nth = 1").drop("p_low", "p_high", "p_nth")
