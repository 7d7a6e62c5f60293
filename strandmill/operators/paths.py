"""Tiling paths: coordinates, continuity, placement of alternative contigs, sub-paths by coordinates.

A path is the rows of one ``ctg_id`` in order of ``ord``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.functions.sequences import parent_contig


def check_continuity(paths: DataFrame) -> DataFrame:
    """The same rows; reading one whose ``v`` isn't the ``w`` before it raises."""
    before = F.lag("w").over(W.partitionBy("ctg_id").orderBy("ord"))
    broken = before.isNotNull() & (before != F.col("v"))
    message = F.concat(F.lit("Tiling path is not in sorted order at node "), F.col("v"))
    return paths.withColumn("v", F.when(broken, F.raise_error(message).cast("string")).otherwise(F.col("v")))


def path_coordinates(paths: DataFrame, step: Column | None = None, contig_lengths: DataFrame | None = None) -> DataFrame:
    """Adds ``v_coord, w_coord, contig_len``.

    With ``contig_lengths`` (``ctg_id, length``) the first node is as long as the sequence exceeds the path; a sequence
    shorter than its path raises.
    """
    step = F.abs(F.col("b") - F.col("e")) if step is None else step
    w = W.partitionBy("ctg_id").orderBy("ord")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = paths.withColumn("p_step", step).withColumn("w_coord", F.sum("p_step").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    rows = rows.withColumn("v_coord", F.col("w_coord") - F.col("p_step")).withColumn("contig_len", F.max("w_coord").over(whole)).drop("p_step")
    if contig_lengths is None:
        return rows
    known = contig_lengths.select(F.col("ctg_id").alias("l_id"), F.col("length").alias("l_length"))
    met = rows.join(known, F.col("ctg_id") == F.col("l_id"), "left")
    short = F.raise_error(F.concat(F.lit("sequence is shorter than its path: "), F.col("ctg_id"))).cast("long")
    offset = F.when(F.col("l_length") < F.col("contig_len"), short).otherwise(F.coalesce(F.col("l_length") - F.col("contig_len"), F.lit(0)))
    met = met.withColumn("p_offset", offset)
    for c in ("v_coord", "w_coord", "contig_len"):
        met = met.withColumn(c, F.col(c) + F.col("p_offset"))
    return met.drop("p_offset", "l_id", "l_length")


def node_coordinates(located: DataFrame) -> DataFrame:
    """``ctg_id, node, coord``: of a node that is visited again the last coordinate counts."""
    seen = located.select("ctg_id", F.col("w").alias("node"), F.col("w_coord").alias("coord"), F.col("ord").alias("seq")).unionByName(
        located.groupBy("ctg_id").agg(F.min_by("v", "ord").alias("node"), F.min_by("v_coord", "ord").alias("coord")).withColumn("seq", F.lit(None).cast("long"))
    )
    return seen.groupBy("ctg_id", "node").agg(F.max_by("coord", F.coalesce("seq", F.lit(-(1 << 62)))).alias("coord"))


def path_ends(paths: DataFrame) -> DataFrame:
    """``ctg_id, first_node, last_node``."""
    return paths.groupBy("ctg_id").agg(F.min_by("v", "ord").alias("first_node"), F.max_by("w", "ord").alias("last_node"))


def place_alternatives(primary: DataFrame, alternatives: DataFrame) -> DataFrame:
    """``a_ctg_id, p_ctg_id, start, end, first_node, last_node``; a missing parent or node raises.

    primary: rows of :func:`path_coordinates`; alternatives: path rows whose contig names tell their parent.
    """
    coords = node_coordinates(primary)
    ends = path_ends(alternatives).select(F.col("ctg_id").alias("a_ctg_id"), parent_contig(F.col("ctg_id")).alias("p_ctg_id"), "first_node", "last_node")
    for which, node in (("start", "first_node"), ("end", "last_node")):
        at = coords.select(F.col("ctg_id").alias("c_id"), F.col("node").alias("c_node"), F.col("coord").alias("c_coord"))
        ends = ends.join(at, (F.col("p_ctg_id") == F.col("c_id")) & (F.col(node) == F.col("c_node")), "left")
        lost = F.raise_error(F.concat(F.lit("no place for "), F.col("a_ctg_id"))).cast("long")
        ends = ends.withColumn(which, F.when(F.col("c_id").isNull(), lost).otherwise(F.col("c_coord"))).drop("c_id", "c_node", "c_coord")
    return ends


def sub_paths(located: DataFrame, ranges: DataFrame) -> DataFrame:
    """Edges that cover a coordinate range, for many ranges (``ctg_id, start, end``) at once.

    Rows of ``located`` with ``start, end`` and the range relative to the first edge, ``new_start, new_end``. The first edge is
    the last one with v_coord <= start < w_coord, or the path's first where the range begins before it; the last edge is
    the last with v_coord < end <= w_coord, the path's last from its end on, and the first where the range ends before it.
    """
    asked = ranges.select(F.col("ctg_id").alias("r_id"), F.col("start"), F.col("end"))
    asked = asked.withColumn("start", F.when(F.col("start") > F.col("end"), F.raise_error(F.lit("end before start")).cast("long")).otherwise(F.col("start")))
    w = W.partitionBy("ctg_id", "start", "end").orderBy("ord")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    met = located.join(asked, F.col("ctg_id") == F.col("r_id")).drop("r_id")
    met = met.withColumn("s_nth", F.row_number().over(w)).withColumn("s_n", F.count(F.lit(1)).over(whole))
    met = met.withColumn("s_first", F.first("v_coord").over(whole)).withColumn("s_last", F.last("w_coord").over(whole))
    begins = F.max(F.when((F.col("v_coord") <= F.col("start")) & (F.col("start") < F.col("w_coord")), F.col("s_nth"))).over(whole)
    ends = F.max(F.when((F.col("v_coord") < F.col("end")) & (F.col("end") <= F.col("w_coord")), F.col("s_nth"))).over(whole)
    met = met.withColumn("s_from", F.coalesce(begins, F.when(F.col("start") < F.col("s_first"), F.lit(1))))
    met = met.withColumn("s_to", F.when(F.col("end") >= F.col("s_last"), F.col("s_n")).otherwise(F.coalesce(ends, F.when(F.col("end") <= F.col("s_first"), F.lit(1)))))
    base = F.max(F.when(F.col("s_nth") == F.col("s_from"), F.col("v_coord"))).over(whole)
    met = met.withColumn("new_start", F.col("start") - base).withColumn("new_end", F.col("end") - base)
    return met.filter(F.col("s_nth").between(F.col("s_from"), F.col("s_to"))).drop("s_nth", "s_n", "s_first", "s_last", "s_from", "s_to")
