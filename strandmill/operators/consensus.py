"""Piles of reads and their consensus.

A pile stream is lines ``id sequence`` in order; ``+`` closes a pile, ``*`` discards it, ``-`` ends the stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.functions.sequences import clean_regions, floor_div
from strandmill.kernels.consensus import ConsensusConfig, consensus_at_offsets, pile_consensus
from strandmill.session import object_frame, ship_package

# Reads longer than this are cut, to one base less; shortest consensus; most regions of one seed.
MAX_READ = 100_000
MIN_CONSENSUS = 500
MAX_REGIONS = 10


def pile_rows(lines: DataFrame) -> DataFrame:
    """``stream, ord, line`` -> ``stream, pile, ord, read_id, sequence`` of the piles that a ``+`` closes.

    Lines without exactly two words are skipped; a pile that nothing closes, or that comes after ``-``, is dropped.
    """
    words = F.split(F.trim(F.col("line")), r"\s+")
    rows = lines.withColumn("words", words).filter(F.size("words") == 2)
    rows = rows.select("stream", "ord", F.col("words")[0].alias("read_id"), F.col("words")[1].alias("sequence"))
    before = W.partitionBy("stream").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)
    closes = F.col("read_id").isin("+", "*")
    rows = rows.withColumn("ended", F.coalesce(F.max(F.when(F.col("read_id") == "-", 1)).over(before), F.lit(0)))
    rows = rows.filter("ended = 0").withColumn("pile", F.coalesce(F.sum(F.when(closes, 1).otherwise(0)).over(before), F.lit(0)))
    whole = W.partitionBy("stream", "pile")
    rows = rows.withColumn("closed", F.max(F.when(F.col("read_id") == "+", 1)).over(whole))
    return rows.filter("closed = 1").filter(~F.col("read_id").isin("+", "*", "-")).select("stream", "pile", "ord", "read_id", _cut_read().alias("sequence"))


def _cut_read() -> Column:
    return F.when(F.length("sequence") > MAX_READ, F.substring("sequence", 1, MAX_READ - 1)).otherwise(F.col("sequence"))


def piles(rows: DataFrame, config: ConsensusConfig = ConsensusConfig()) -> DataFrame:
    """``stream, pile, seed_id, seed, reads array<string>``: accepted piles, their reads longest first.

    The first long enough read is the seed and also votes; a read id counts once. A pile needs ``min_n_read`` entries (seed
    included twice) and coverage ``min_cov_aln`` of its seed; excess reads are cut off longest first. Too long reads are cut as in
    ``pile_rows``. Windows see lengths; a sequence moves once, with its own row.
    """
    long = rows.filter(F.length("sequence") >= config.min_len_aln).withColumn("sequence", _cut_read()).withColumn("n", F.length("sequence"))
    w = W.partitionBy("stream", "pile").orderBy("ord")
    once = W.partitionBy("stream", "pile", "read_id").orderBy("ord")
    kept = long.withColumn("seed_n", F.first("n").over(w)).withColumn("at", F.row_number().over(w))
    kept = kept.withColumn("nth", F.row_number().over(once)).filter("nth = 1")
    # A read stays while the reads before it, longest first, cover the seed at most max_cov_aln times.
    ranked = W.partitionBy("stream", "pile").orderBy(F.col("n").desc(), "ord")
    kept = kept.withColumn("rank", F.row_number().over(ranked)).withColumn("bases", F.coalesce(F.sum("n").over(ranked.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    over = F.lit(False) if config.max_cov_aln <= 0 else floor_div(F.col("bases"), F.col("seed_n")) > config.max_cov_aln
    whole = W.partitionBy("stream", "pile")
    kept = kept.withColumn("reads_n", F.count(F.lit(1)).over(whole)).withColumn("cov", floor_div(F.sum("n").over(whole), F.col("seed_n")))
    kept = kept.filter((F.col("reads_n") + 1 >= config.min_n_read) & (F.col("cov") >= config.min_cov_aln))
    votes, seed = ~over & (F.col("rank") <= config.max_n_read - 1), F.col("at") == 1
    grouped = kept.filter(votes | seed).groupBy("stream", "pile").agg(
        F.max(F.when(seed, F.col("read_id"))).alias("seed_id"), F.max(F.when(seed, F.col("sequence"))).alias("seed"),
        F.sort_array(F.collect_list(F.when(votes, F.struct("rank", "sequence")))).alias("ranked"),
    )
    return grouped.filter(F.size("ranked") > 0).select("stream", "pile", "seed_id", "seed", F.transform("ranked", lambda r: r["sequence"]).alias("reads"))


def pile_consensuses(accepted: DataFrame, config: ConsensusConfig = ConsensusConfig(), trim: bool = False) -> DataFrame:
    """``stream, pile, seed_id, consensus`` of at least 500 bases; lower case where coverage is thin."""
    ship_package(accepted.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [pile_consensus([seed, *reads], config, trim) for seed, reads in zip(frame["seed"], frame["reads"], strict=True)]
            yield object_frame(zip(frame["stream"], frame["pile"], frame["seed_id"], made, strict=True), ["stream", "pile", "seed_id", "consensus"])

    found = accepted.select("stream", "pile", "seed_id", "seed", "reads").mapInPandas(run, "stream string, pile long, seed_id string, consensus string")
    return found.filter(F.length("consensus") >= MIN_CONSENSUS)


def full_records(found: DataFrame) -> DataFrame:
    """``name, sequence``: everything, thin parts included."""
    return found.select(F.concat("seed_id", F.lit("_f")).alias("name"), F.col("consensus").alias("sequence"))


def region_records(found: DataFrame) -> DataFrame:
    """``name, sequence`` of the first ten clean regions of at least 500 bases; the names lead back to the seed by integer division by ten."""
    regions = F.slice(F.filter(clean_regions(F.col("consensus")), lambda s: F.length(s) >= MIN_CONSENSUS), 1, MAX_REGIONS)
    rows = found.select("seed_id", F.posexplode(regions).alias("i", "sequence"))
    name = F.concat(F.lit("prolog/"), "seed_id", F.col("i").cast("string"), F.lit("/0_"), F.length("sequence").cast("string"))
    return rows.select(name.alias("name"), "sequence")


def longest_records(found: DataFrame) -> DataFrame:
    """``name, sequence`` of each longest clean region, the last of several."""
    regions = F.transform(clean_regions(F.col("consensus")), lambda s, i: F.struct(F.length(s).alias("n"), i.alias("i"), s.alias("sequence")))
    return found.select("seed_id", F.array_max(regions).alias("best")).filter("best IS NOT NULL").select(F.col("seed_id").alias("name"), F.col("best.sequence").alias("sequence"))


def offset_consensuses(layouts: DataFrame, min_identity: float = 0.7) -> DataFrame:
    """``id, reads array<string>, offsets array<int>`` -> ``id, consensus``: reads placed on the first one."""
    ship_package(layouts.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [consensus_at_offsets(list(r), [int(x) for x in o], min_identity)[0] for r, o in zip(frame["reads"], frame["offsets"], strict=True)]
            yield object_frame(zip(frame["id"], made, strict=True), ["id", "consensus"])

    return layouts.select("id", "reads", "offsets").mapInPandas(run, "id string, consensus string")
