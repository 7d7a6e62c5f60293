"""Command line: ``python -m strandmill.plans.cli filter|assemble|track|collect-gfa|gfa|paths|stats ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.functions.sequences import parent_contig
from strandmill.operators import gfa, overlaps, paths, stats, tracking
from strandmill.plans.assembly import assemble
from strandmill.plans.config import AssemblyConfig
from strandmill.session import settle
from strandmill.sources import readers, sinks


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description="Sequence overlap, consensus and assembly-graph analytics on Spark.")
    sub = out.add_subparsers(dest="command", required=True)
    f = sub.add_parser("filter", help="keep the best overlaps of each read end")
    f.add_argument("overlaps")
    f.add_argument("out")
    for name, default in (("max-diff", 1000), ("max-cov", 1000), ("min-cov", 1), ("min-len", 2500), ("bestn", 10)):
        f.add_argument(f"--{name}", type=int, default=default)
    a = sub.add_parser("assemble", help="overlaps and reads to contigs")
    a.add_argument("overlaps")
    a.add_argument("reads")
    a.add_argument("out")
    for name, default in (("max-diff", 120), ("max-cov", 120), ("min-cov", 2), ("min-len", 4000), ("bestn", 10)):
        a.add_argument(f"--{name}", type=int, default=default)
    a.add_argument("--min-identity", type=float, default=96.0)
    a.add_argument("--keep-chimeras", action="store_true")
    a.add_argument("--local-flow", action="store_true")
    a.add_argument("--improper-contigs", action="store_true", help="leave out the first read of primary contigs")
    a.add_argument("--proper-alternatives", action="store_true", help="put the first read before alternatives")
    t = sub.add_parser("track", help="reads to ranked contigs by their best overlaps")
    t.add_argument("overlaps")
    t.add_argument("contig_map", help="lines of corrected read, raw read, original name, contig")
    t.add_argument("out")
    t.add_argument("--by", choices=("rid", "pid"), default="rid", help="are the overlaps' ids those of raw or of corrected reads?")
    t.add_argument("--min-len", type=int, default=2500)
    t.add_argument("--bestn", type=int, default=40)
    g = sub.add_parser("collect-gfa", help="tiling paths, reads and overlaps to a graph as JSON")
    for name in ("primary_tiling", "alternative_tiling", "reads", "primary", "alternative", "edges", "overlaps", "out"):
        g.add_argument(name)
    g.add_argument("--string-graph", action="store_true", help="add all live edges of the string graph")
    g.add_argument("--write-reads", action="store_true", help="with sequences, not lengths alone")
    g.add_argument("--only", help="file of primary contigs to keep, with their alternatives")
    w = sub.add_parser("gfa", help="a graph's JSON as GFA")
    w.add_argument("graph")
    w.add_argument("out")
    w.add_argument("--version", type=int, choices=(1, 2), default=1)
    p = sub.add_parser("paths", help="a file list with absolute paths")
    p.add_argument("listed")
    p.add_argument("out")
    s = sub.add_parser("stats", help="length statistics and coverage cutoff of reads")
    s.add_argument("reads")
    s.add_argument("--bases", type=int, help="bases that reads at least as long as the cutoff must hold")
    return out


def collected_graph(spark: SparkSession, args: argparse.Namespace) -> gfa.GfaGraph:
    """The graph of ``collect-gfa``: reads as nodes, steps of primary and alternative paths as edges, contigs as paths."""
    reads = readers.sequence_dictionary(readers.read_sequences(spark, args.reads), not args.write_reads)
    lines = readers.read_overlaps(spark, args.overlaps)
    pairs = settle(gfa.pread_overlap_pairs(lines.withColumn("place", F.dense_rank().over(W.partitionBy("q_id", "t_id").orderBy("file", "ord")).cast("long")).drop("file", "ord"), "place"))
    located = []
    p_names = readers.read_sequences(spark, args.primary)
    if args.only:
        only = spark.read.text(args.only).select(F.trim("value").alias("k_id")).distinct()
        p_names = p_names.join(only, F.col("id") == F.col("k_id"), "left_semi")
    a_names = readers.read_sequences(spark, args.alternative)
    if args.only:
        a_names = a_names.join(p_names.select(F.col("id").alias("k_id")), parent_contig(F.col("id")) == F.col("k_id"), "left_semi")
    for names, tiling in ((p_names, args.primary_tiling), (a_names, args.alternative_tiling)):
        lengths = names.select(F.col("id").alias("ctg_id"), F.col("length").cast("long").alias("length"))
        located.append(paths.path_coordinates(readers.read_tiling_paths(spark, tiling, lengths), contig_lengths=lengths))
    graph = gfa.tiling_graph(settle(located[0].unionByName(located[1])), reads, pairs)
    if args.string_graph:
        edges = settle(graph.edges)
        graph = gfa.with_string_graph(gfa.GfaGraph(graph.nodes, edges, graph.paths), readers.read_edges(spark, args.edges), reads, pairs)
    return graph


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("strandmill").getOrCreate()
    if args.command == "filter":
        limits = overlaps.CoverageLimits(args.max_diff, args.max_cov, args.min_cov, args.min_len)
        rows = readers.read_overlaps(spark, args.overlaps)
        sinks.write_overlaps(overlaps.filter_overlaps(rows, args.bestn, limits, group_by=["file"]), args.out, marker=True)
    elif args.command == "assemble":
        reads = readers.read_sequences(spark, args.reads)
        config = AssemblyConfig(
            max_diff=args.max_diff, max_cov=args.max_cov, min_cov=args.min_cov, min_len=args.min_len, bestn=args.bestn, min_identity=args.min_identity,
            remove_chimeras=not args.keep_chimeras, local_flow=args.local_flow, improper_contigs=args.improper_contigs, proper_alternatives=args.proper_alternatives,
        )
        made = assemble(readers.read_overlaps(spark, args.overlaps).drop("file", "ord"), reads, config)
        sinks.write_overlaps(made.overlaps, f"{args.out}/overlaps", marker=True)
        sinks.write_text(made.chimeras.select(F.col("node").alias("value")), f"{args.out}/chimeric_nodes")
        sinks.write_text(sinks.edge_text(made.edges), f"{args.out}/edges")
        sinks.write_text(sinks.unitig_text(made.unitigs), f"{args.out}/unitigs")
        sinks.write_text(sinks.contig_text(made.contigs), f"{args.out}/contig_paths")
        sinks.write_contigs(made.sequences, made.contigs, made.tiling, made.all_alternatives, args.out)
        sinks.write_fasta(sinks.alternative_records(made.alternatives), f"{args.out}/distinct_alternative", width=None)
    elif args.command == "track":
        rows = readers.read_overlaps(spark, args.overlaps).withColumn("overlap_len", -F.col("score"))
        mapped = readers.read_contig_map(spark, args.contig_map).select(F.col(args.by).alias("rid"), "ctg")
        sinks.write_text(sinks.track_text(tracking.track_reads(rows, mapped, args.min_len, args.bestn)), args.out)
    elif args.command == "collect-gfa":
        sinks.write_gfa_json(collected_graph(spark, args), args.out)
    elif args.command == "gfa":
        graph = sinks.read_gfa_json(spark, args.graph)
        (sinks.write_gfa1 if args.version == 1 else sinks.write_gfa2)(graph, args.out)
    elif args.command == "paths":
        found = readers.absolute_paths(spark, args.listed)
        sinks.write_text(spark.createDataFrame([(x,) for x in found], "value string").coalesce(1), args.out)
    else:
        histogram = stats.length_histogram(readers.read_sequences(spark, args.reads), F.col("length"))
        print(stats.report_json(stats.read_stats(histogram)))
        if args.bases is not None:
            print(stats.coverage_cutoff(histogram, args.bases).first()[0])
    return 0


if __name__ == "__main__":
    sys.exit(main())
