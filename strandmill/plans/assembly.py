"""Overlaps and reads to contigs: the whole plan, step by step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.operators import assembly, graph, overlaps
from strandmill.plans.config import AssemblyConfig
from strandmill.session import settle


@dataclass(frozen=True)
class Assembly:
    overlaps: DataFrame
    edges: DataFrame
    unitigs: DataFrame
    contigs: DataFrame
    tiling: DataFrame
    sequences: DataFrame
    all_alternatives: DataFrame
    alternatives: DataFrame
    chimeras: DataFrame


def assemble(rows: DataFrame, reads: DataFrame, config: AssemblyConfig = AssemblyConfig()) -> Assembly:
    """``alternatives`` are without those that are nearly the primary path; ``chimeras`` are the nodes (``node``) whose edges went as chimeric.

    rows: ``schema.OVERLAPS``; reads: ``id, sequence``. Of several overlaps of a pair the one that sorts first by ids and score counts."""
    limits = overlaps.CoverageLimits(config.max_diff, config.max_cov, config.min_cov, config.min_len)
    kept = settle(overlaps.filter_overlaps(rows, config.bestn, limits))
    proper = overlaps.graph_rows(kept, config.min_identity, config.min_len)
    order = [F.col(c) for c in ("q_id", "score", "t_id", "q_s", "t_s")]
    typed, chimeras = graph.string_graph_and_chimeras(graph.overlap_edges(proper, order), config.remove_chimeras, config.local_flow)
    edges = settle(typed)
    live = edges.filter("type = 'G'")
    unitigs = settle(assembly.simplify_unitigs(graph.simple_paths(live)))
    best_in = graph.best_edges(live).filter("best_in").select(F.col("w").alias("node"), F.col("v").alias("best"))
    kept_unitigs = unitigs.filter(F.col("type").isin("simple", "compound", "contained"))
    contigs = settle(assembly.contig_paths(unitigs, None if config.local_flow else best_in))
    tiling = settle(assembly.tilings(assembly.laid_out(contigs), kept_unitigs, live))
    sequences = settle(assembly.tiling_sequences(tiling, reads, not config.improper_contigs, config.proper_alternatives))
    found = settle(assembly.alternative_contigs(sequences))
    return Assembly(kept, edges, unitigs, contigs, tiling, sequences, found, assembly.distinct_alternatives(found), chimeras)
