"""Read tracking: best overlaps of each read, votes for contigs, read-to-contig maps, partitions of reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.functions.sequences import floor_div, read_name

# Hits that a listed contig needs at least.
MIN_HITS = 5
UNASSIGNED = "unassigned"


def top_overlaps(overlaps: DataFrame, min_len: int, bestn: int, mapped: DataFrame) -> DataFrame:
    """``t_id, overlap_len, q_id``: of each target the ``bestn`` longest overlaps with mapped reads, ties to the larger query id.

    mapped: ``rid``. Row numbers up to a bound are cut on the map side first, so a hot target moves few rows.
    """
    known = mapped.select(F.col("rid").alias("k_rid")).distinct()
    rows = overlaps.filter(F.col("t_l") >= min_len).join(known, F.col("q_id") == F.col("k_rid"), "left_semi")
    w = W.partitionBy("t_id").orderBy(F.col("overlap_len").desc(), F.col("q_id").desc())
    ranked = rows.select("t_id", (-F.col("score")).alias("overlap_len"), "q_id").withColumn("nth", F.row_number().over(w))
    return ranked.filter(F.col("nth") <= bestn).drop("nth")


def contig_votes(top: DataFrame, mapped: DataFrame) -> DataFrame:
    """``bread, ctg, count, score``: overlaps vote for all contigs of their read; score is the negated total length."""
    m = mapped.select(F.col("rid").alias("m_rid"), "ctg").distinct()
    met = top.join(m, F.col("q_id") == F.col("m_rid"))
    return met.groupBy(F.col("t_id").alias("bread"), "ctg").agg(F.count(F.lit(1)).alias("count"), (-F.sum("overlap_len")).alias("score"))


def ranked_contigs(votes: DataFrame, mapped: DataFrame) -> DataFrame:
    """Votes with ``rank`` from 0 (most overlap first, ties by name) and ``in_ctg``: is the read itself mapped there?"""
    own = mapped.select(F.col("rid").alias("o_rid"), F.col("ctg").alias("o_ctg")).distinct()
    met = votes.join(own, (F.col("bread") == F.col("o_rid")) & (F.col("ctg") == F.col("o_ctg")), "left")
    rank = F.row_number().over(W.partitionBy("bread").orderBy("score", "ctg")) - 1
    return met.select("bread", "ctg", "count", rank.alias("rank"), "score", F.when(F.col("o_rid").isNotNull(), 1).otherwise(0).alias("in_ctg"))


def track_reads(overlaps: DataFrame, mapped: DataFrame, min_len: int = 2500, bestn: int = 40) -> DataFrame:
    """``bread, ctg, count, rank, score, in_ctg``: overlaps to ranked contigs."""
    return ranked_contigs(contig_votes(top_overlaps(overlaps, min_len, bestn, mapped), mapped), mapped)


def seed_of(name: Column) -> Column:
    """The raw-read number behind a corrected read's name ``prolog/<seed><i>/0_<len>``."""
    return floor_div(F.split_part(name, F.lit("/"), F.lit(2)).cast("long"), F.lit(10))


def id_chain(pread_names: DataFrame, rawread_names: DataFrame) -> DataFrame:
    """``pid, rid, oid``: corrected read -> raw read -> original name. Both tables: ``ord`` (line number from 0), ``name``."""
    p = pread_names.select(F.col("ord").alias("pid"), seed_of(F.col("name")).alias("rid"))
    r = rawread_names.select(F.col("ord").alias("r_ord"), F.col("name").alias("oid"))
    return p.join(r, F.col("rid") == F.col("r_ord")).select("pid", "rid", "oid")


def read_to_contig_map(contig_nodes: DataFrame, chain: DataFrame) -> DataFrame:
    """``pid, rid, oid, ctg`` with padded ids; reverse contigs are left out. contig_nodes: ``ctg_id, node``."""
    forward = contig_nodes.filter(~F.col("ctg_id").endswith("R"))
    named = forward.select(F.col("ctg_id").alias("ctg"), F.split_part("node", F.lit(":"), F.lit(1)).cast("long").alias("n_pid")).distinct()
    met = named.join(chain, F.col("n_pid") == F.col("pid"))
    return met.select(read_name(F.col("pid")).alias("pid"), read_name(F.col("rid")).alias("rid"), "oid", "ctg").distinct()


def read_assignments(raw_tracks: DataFrame, pread_tracks: DataFrame, chain: DataFrame, rawread_names: DataFrame) -> DataFrame:
    """``oid, ctg`` by rank-0 votes; a corrected read's vote replaces its raw read's. Contigs lose what follows the first dash.

    Of several corrected reads of one raw read the last by id counts.
    """
    best = lambda t: t.filter("rank = 0").select(F.col("bread").cast("long").alias("id"), F.split_part("ctg", F.lit("-"), F.lit(1)).alias("ctg"))
    names = rawread_names.select(F.col("ord").alias("n_ord"), F.col("name").alias("oid"))
    raw = best(raw_tracks).join(names, F.col("id") == F.col("n_ord")).select("oid", "ctg", F.lit(0).alias("source"), "id")
    pre = best(pread_tracks).join(chain, F.col("id") == F.col("pid")).select("oid", "ctg", F.lit(1).alias("source"), "id")
    return raw.unionByName(pre).groupBy("oid").agg(F.max_by("ctg", F.struct("source", "id")).alias("ctg"))


def contig_hits(raw_tracks: DataFrame, pread_tracks: DataFrame) -> DataFrame:
    """``ctg, hits``: rank-0 votes of raw and corrected reads."""
    both = raw_tracks.select("ctg", "rank").unionByName(pread_tracks.select("ctg", "rank")).filter("rank = 0")
    return both.groupBy(F.split_part("ctg", F.lit("-"), F.lit(1)).alias("ctg")).agg(F.count(F.lit(1)).alias("hits"))


def listed_contigs(contigs: DataFrame, hits: DataFrame, min_length: int = 20000) -> DataFrame:
    """``ctg_id`` of linear contigs (names end in F or R), long enough and hit at least five times, in order. contigs: ``id, sequence``."""
    long = contigs.filter(F.length("sequence") >= min_length).select(F.col("id").alias("ctg_id"))
    met = long.join(hits.select(F.col("ctg").alias("h_ctg"), "hits"), F.col("ctg_id") == F.col("h_ctg"), "left")
    kept = met.filter((F.coalesce("hits", F.lit(0)) >= MIN_HITS) & F.col("ctg_id").rlike("[FR]$"))
    return kept.select("ctg_id").orderBy("ctg_id")


def partition_reads(reads: DataFrame, assignments: DataFrame, contigs: DataFrame, min_length: int = 20000) -> DataFrame:
    """Reads with ``ctg``: their contig, or ``unassigned`` where they have none, or none that is long enough."""
    known = contigs.filter(F.length("sequence") >= min_length).select(F.col("id").alias("c_id")).distinct()
    a = assignments.select(F.col("oid").alias("a_oid"), F.col("ctg").alias("a_ctg")).join(known, F.col("a_ctg") == F.col("c_id"), "left_semi")
    return reads.join(a, F.col("id") == F.col("a_oid"), "left").withColumn("ctg", F.coalesce("a_ctg", F.lit(UNASSIGNED))).drop("a_oid", "a_ctg")


def annotated_path(located: DataFrame, memberships: DataFrame) -> DataFrame:
    """``ctg_id, node, coord, ctgs``: nodes of paths with all contigs that touch them. located: rows with ``ord, v, w, v_coord, w_coord``."""
    first = located.filter("ord = 1").select("ctg_id", F.lit(0).alias("ord"), F.col("v").alias("node"), F.col("v_coord").alias("coord"))
    rows = first.unionByName(located.select("ctg_id", "ord", F.col("w").alias("node"), F.col("w_coord").alias("coord")))
    touching = memberships.groupBy(F.col("node").alias("t_node")).agg(F.array_join(F.array_sort(F.collect_set("ctg_id")), " ").alias("ctgs"))
    return rows.join(touching, F.col("node") == F.col("t_node"), "left").select("ctg_id", "ord", "node", "coord", F.coalesce("ctgs", F.lit("")).alias("ctgs"))
