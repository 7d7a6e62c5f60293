"""K-mer seeds as joins, and alignment kernels as Arrow-batched functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.functions.sequences import kmers
from strandmill.kernels import alignment
from strandmill.session import object_frame, ship_package


def kmer_table(sequences: DataFrame, k: int, step: int = 1) -> DataFrame:
    """``id, sequence`` -> ``id, pos, kmer``."""
    return sequences.select("id", F.explode(kmers(F.col("sequence"), k, step)).alias("x")).select("id", F.col("x.pos").alias("pos"), F.col("x.kmer").alias("kmer"))


def mask_kmers(table: DataFrame, threshold: int) -> DataFrame:
    """Rows of k-mers that occur ``threshold`` times at most. The counts are combined before the shuffle."""
    frequent = table.groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > threshold).select(F.col("kmer").alias("f_kmer"))
    return table.join(frequent, F.col("kmer") == F.col("f_kmer"), "left_anti")


#: Target k-mers that occur more often than this are masked unless the caller says otherwise.
MAX_COUNT = 64


def seed_join(queries: DataFrame, targets: DataFrame, k: int, max_count: int | None = MAX_COUNT) -> DataFrame:
    """``q_id, t_id, q_pos, t_pos`` of common k-mers; queries are sampled every k/2 positions.

    Target k-mers that occur over ``max_count`` times are masked, which also bounds what one key of the join can produce; None masks none.
    """
    t = kmer_table(targets, k)
    if max_count is not None:
        t = mask_kmers(t, max_count)
    t = t.select(F.col("id").alias("t_id"), F.col("pos").alias("t_pos"), "kmer")
    q = kmer_table(queries, k, max(k // 2, 1)).select(F.col("id").alias("q_id"), F.col("pos").alias("q_pos"), "kmer")
    return q.join(t, "kmer").select("q_id", "t_id", "q_pos", "t_pos")


def diagonal_bins(seeds: DataFrame, bin_size: int) -> DataFrame:
    """``q_id, t_id, bin, count``: seeds by diagonal, counted from the pair's lowest one."""
    d = F.col("q_pos") - F.col("t_pos")
    lowest = seeds.groupBy(F.col("q_id").alias("l_q"), F.col("t_id").alias("l_t")).agg(F.min(d).alias("lowest"))
    met = seeds.join(lowest, (F.col("q_id") == F.col("l_q")) & (F.col("t_id") == F.col("l_t")))
    return met.groupBy("q_id", "t_id", F.floor((d - F.col("lowest")) / bin_size).alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def candidate_pairs(reads: DataFrame, k: int, max_count: int, min_seeds: int) -> DataFrame:
    """``q_id, t_id, seeds``: pairs of different reads, q_id < t_id, with enough common seeds: the all-against-all join."""
    seeds = seed_join(reads, reads, k, max_count).filter("q_id < t_id")
    return seeds.groupBy("q_id", "t_id").agg(F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= min_seeds)


def align_pairs(pairs: DataFrame, mode: str = "exact") -> DataFrame:
    """``q_id, t_id, q_seq, t_seq`` -> ``q_id, t_id, s1, e1, s2, e2, size, score``; pairs without an alignment are left out.

    mode: ``exact`` (score is the number of differences) or ``sparse`` (score by seeds).
    """
    ship_package(pairs.sparkSession)
    kernel = {"exact": alignment.exact_alignment, "sparse": alignment.sparse_alignment}[mode]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for q, t, a, b in zip(frame["q_id"], frame["t_id"], frame["q_seq"], frame["t_seq"], strict=True):
                if (found := kernel(a, b)) is not None:
                    rows.append((q, t, *found))
            yield object_frame(rows, ["q_id", "t_id", "s1", "e1", "s2", "e2", "size", "score"])

    return pairs.select("q_id", "t_id", "q_seq", "t_seq").mapInPandas(run, "q_id string, t_id string, s1 int, e1 int, s2 int, e2 int, size int, score int")


def contig_identities(pairs: DataFrame) -> DataFrame:
    """``base_id, other_id, base_seq, other_seq`` -> ``base_id, other_id, identity, coverage``: 0 without an alignment, -1 if too long."""
    ship_package(pairs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for base, other, a, b in zip(frame["base_id"], frame["other_id"], frame["base_seq"], frame["other_seq"], strict=True):
                try:
                    found = alignment.pair_identity(a, b) or (0.0, 0.0)
                except alignment.TooLong:
                    found = (-1.0, -1.0)
                rows.append((base, other, *found))
            yield object_frame(rows, ["base_id", "other_id", "identity", "coverage"])

    return pairs.select("base_id", "other_id", "base_seq", "other_seq").mapInPandas(run, "base_id string, other_id string, identity double, coverage double")
