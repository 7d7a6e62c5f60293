"""Assembly graphs for export: nodes, edges and paths as three DataFrames, GFA-1, GFA-2 and JSON renderings.

nodes: ``name, len, seq``; edges: ``name, v, v_orient, w, w_orient, v_start, v_end, w_start, w_end, cigar``; paths:
``name, nodes array<string>, cigars array<string>``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.functions.sequences import node_orient, node_read
from strandmill.operators.paths import path_coordinates, place_alternatives

NODE_COLUMNS = ["name", "len", "seq"]
EDGE_COLUMNS = ["name", "v", "v_orient", "w", "w_orient", "v_start", "v_end", "w_start", "w_end", "cigar"]
PATH_COLUMNS = ["name", "nodes", "cigars"]


@dataclass(frozen=True)
class GfaGraph:
    nodes: DataFrame
    edges: DataFrame
    paths: DataFrame


def _checked(df: DataFrame, first: str, rules: list[tuple[Column, str]]) -> DataFrame:
    """Reading ``first`` of a row that breaks a rule raises."""
    value = F.col(first)
    for broken, message in reversed(rules):
        value = F.when(F.coalesce(broken, F.lit(True)), F.raise_error(F.lit(message)).cast("string")).otherwise(value)
    return df.withColumn(first, value)


def _filled(*columns: str) -> list[tuple[Column, str]]:
    return [(F.col(c) == "", f"{c} is empty (an unknown value is written *)") for c in columns]


def _counted(*columns: str) -> list[tuple[Column, str]]:
    return [(F.col(c) < 0, f"{c} is negative") for c in columns]


def checked_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes have a name, a sequence (or *) and a length."""
    return _checked(nodes, "name", [*_filled("name", "seq"), *_counted("len")])


def checked_edges(edges: DataFrame) -> DataFrame:
    """Edges have a name, two oriented nodes, a CIGAR (or *), and on either node a stretch that doesn't run backwards."""
    rules = _filled("name", "cigar", "v", "w")
    for side in "v", "w":
        rules += [
            (~F.col(f"{side}_orient").isin("+", "-"), f"{side}_orient is neither + nor -"),
            *_counted(f"{side}_start", f"{side}_end"),
            (F.col(f"{side}_start") > F.col(f"{side}_end"), f"{side}_start lies behind {side}_end"),
        ]
    return _checked(edges, "name", rules)


def checked_paths(paths: DataFrame) -> DataFrame:
    """Paths have a name and, for each of one or more nodes, a CIGAR."""
    uneven = (F.size("nodes") < 1) | (F.size("nodes") != F.size("cigars"))
    return _checked(paths, "name", [*_filled("name"), (uneven, "a path takes one CIGAR for each node, and one node at least")])


def last_edges(edges: DataFrame, order: str) -> DataFrame:
    """One edge per (source, sink): the last in order replaces the others."""
    w = W.partitionBy("v", "w").orderBy(F.col(order).desc())
    return edges.withColumn("g_nth", F.row_number().over(w)).filter("g_nth = 1").drop("g_nth")


def pread_overlap_pairs(overlaps: DataFrame, order: str) -> DataFrame:
    """One overlap per ordered read pair: the last row of that direction, else the first of the other one, turned round."""
    columns = [c for c in overlaps.columns if c != order]
    turned = {"q_id": "t_id", "t_id": "q_id"} | {f"{a}_{c}": f"{b}_{c}" for a, b in (("q", "t"), ("t", "q")) for c in ("strand", "s", "e", "l")}
    forward = overlaps.select(*columns, F.lit(0).alias("o_turned"), (-F.col(order)).alias("o_rank"))
    back = overlaps.select(*[F.col(turned.get(c, c)).alias(c) for c in columns], F.lit(1).alias("o_turned"), F.col(order).cast("long").alias("o_rank"))
    w = W.partitionBy("q_id", "t_id").orderBy("o_turned", "o_rank")
    return forward.unionByName(back).withColumn("o_nth", F.row_number().over(w)).filter("o_nth = 1").select(*columns)


def tiling_graph(located: DataFrame, reads: DataFrame, overlaps: DataFrame, order: str = "ord") -> GfaGraph:
    """Reads of tiling paths as nodes, their steps as edges, contigs as paths.

    located: rows of ``path_coordinates``; reads: ``name, len, seq``; overlaps: one row per ordered read pair. A step without an
    overlap raises. Coordinates are given on the forward strand.
    """
    used = located.select(F.explode(F.array(node_read(F.col("v")), node_read(F.col("w")))).alias("u_name")).distinct()
    nodes = reads.join(used, F.col("name") == F.col("u_name"), "left_semi").select(*NODE_COLUMNS)
    steps = located.select("ctg_id", order, node_read(F.col("v")).alias("v"), node_orient(F.col("v")).alias("v_orient"), node_read(F.col("w")).alias("w"), node_orient(F.col("w")).alias("w_orient"))
    numbered = steps.withColumn("nth", F.row_number().over(W.orderBy("ctg_id", order)) - 1)
    edges = _with_overlaps(last_edges(numbered, "nth"), overlaps, F.format_string("edge-%d", F.col("nth")))
    cigar = F.concat(F.abs(F.col("b") - F.col("e")).cast("string"), F.lit("M"))
    grouped = located.groupBy("ctg_id").agg(
        F.min_by(node_read(F.col("v")), order).alias("first"),
        F.min_by("v_coord", order).alias("offset"),
        F.sort_array(F.collect_list(F.struct(F.col(order), node_read(F.col("w")).alias("node"), cigar.alias("cigar")))).alias("rest"),
    )
    paths = grouped.select(
        F.col("ctg_id").alias("name"),
        F.concat(F.array("first"), F.transform("rest", lambda r: r["node"])).alias("nodes"),
        F.concat(F.array(F.concat(F.col("offset").cast("string"), F.lit("M"))), F.transform("rest", lambda r: r["cigar"])).alias("cigars"),
    )
    return GfaGraph(checked_nodes(nodes), checked_edges(edges), checked_paths(paths))


def _with_overlaps(steps: DataFrame, overlaps: DataFrame, name: Column) -> DataFrame:
    o = overlaps.withColumnsRenamed({c: f"o_{c}" for c in overlaps.columns})
    met = steps.join(o, (F.col("v") == F.col("o_q_id")) & (F.col("w") == F.col("o_t_id")), "left")
    lost = F.raise_error(F.concat(F.lit("no overlap of "), F.col("v"), F.lit(" and "), F.col("w"))).cast("int")

    def seen(side: str, which: str) -> Column:
        strand, begin, end, length = (F.col(f"o_{side}_{c}") for c in ("strand", "s", "e", "l"))
        turned = {"s": length - end, "e": length - begin}[which]
        plain = {"s": begin, "e": end}[which]
        return F.when(F.col("o_q_id").isNull(), lost).when(strand == 1, turned).otherwise(plain)

    return met.select(
        name.alias("name"), "v", "v_orient", "w", "w_orient",
        seen("q", "s").alias("v_start"), seen("q", "e").alias("v_end"), seen("t", "s").alias("w_start"), seen("t", "e").alias("w_end"), F.lit("*").alias("cigar"),
    )


def string_graph_edges(edges: DataFrame, overlaps: DataFrame) -> DataFrame:
    """Live string-graph edges as GFA edges."""
    live = edges.filter("type = 'G'").select("v", "w").withColumn("nth", F.row_number().over(W.orderBy("v", "w")) - 1)
    steps = live.select("nth", node_read(F.col("v")).alias("v"), node_orient(F.col("v")).alias("v_orient"), node_read(F.col("w")).alias("w"), node_orient(F.col("w")).alias("w_orient"))
    return _with_overlaps(last_edges(steps, "nth"), overlaps, F.format_string("edge-%d", F.col("nth")))


def with_string_graph(graph: GfaGraph, edges: DataFrame, reads: DataFrame, overlaps: DataFrame) -> GfaGraph:
    """A tiling graph with the reads and live edges of the whole string graph; what both have is kept once, the tiling graph's names first.

    edges: typed string-graph edges; reads and overlaps as in ``tiling_graph``. Added edges are numbered on from the graph's own.
    """
    used = edges.select(F.explode(F.array(node_read(F.col("v")), node_read(F.col("w")))).alias("u_name")).distinct()
    own = graph.nodes.select(F.col("name").alias("own_name"))
    nodes = reads.join(used, F.col("name") == F.col("u_name"), "left_semi").join(own, F.col("name") == F.col("own_name"), "left_anti").select(*NODE_COLUMNS)
    taken = graph.edges.select(F.col("v").alias("own_v"), F.col("w").alias("own_w"))
    steps = edges.filter("type = 'G'").select("v", "w")
    steps = steps.join(taken, (node_read(F.col("v")) == F.col("own_v")) & (node_read(F.col("w")) == F.col("own_w")), "left_anti")
    more = string_graph_edges(steps.withColumn("type", F.lit("G")), overlaps)
    number = F.regexp_extract("name", r"(\d+)$", 1).cast("long")
    first = graph.edges.agg(F.coalesce(F.max(number) + 1, F.lit(0))).first()[0]
    more = more.withColumn("name", F.format_string("edge-%d", number + first))
    return GfaGraph(graph.nodes.unionByName(checked_nodes(nodes)), graph.edges.unionByName(checked_edges(more)), graph.paths)


def contig_graph(primary: DataFrame, alternatives: DataFrame, p_contigs: DataFrame, a_contigs: DataFrame, whitelist: DataFrame | None = None) -> GfaGraph:
    """Contigs as nodes, two edges for each alternative: out of its primary contig and back.

    primary, alternatives: tiling rows; p_contigs, a_contigs: ``name, len, seq``; whitelist: ``ctg_id`` of primary contigs to keep,
    with their alternatives.
    """
    from strandmill.functions.sequences import parent_contig

    if whitelist is not None:
        keep = whitelist.select(F.col("ctg_id").alias("k_id")).distinct()
        p_contigs = p_contigs.join(keep, F.col("name") == F.col("k_id"), "left_semi")
    names = p_contigs.select(F.col("name").alias("k_name"))
    a_contigs = a_contigs.join(names, parent_contig(F.col("name")) == F.col("k_name"), "left_semi") if whitelist is not None else a_contigs
    primary = primary.join(names, F.col("ctg_id") == F.col("k_name"), "left_semi")
    a_names = a_contigs.select(F.col("name").alias("k_name"))
    alternatives = alternatives.join(a_names, F.col("ctg_id") == F.col("k_name"), "left_semi")
    lengths = lambda c: c.select(F.col("name").alias("ctg_id"), F.col("len").cast("long").alias("length"))
    placed = place_alternatives(path_coordinates(primary, contig_lengths=lengths(p_contigs)), alternatives)
    with_len = placed.join(a_contigs.select(F.col("name").alias("l_name"), F.col("len").alias("a_len")), F.col("a_ctg_id") == F.col("l_name"))
    nth = F.row_number().over(W.orderBy("p_ctg_id", "a_ctg_id")) - 1

    def edge(i: int, v: str, w: str, v_at: Column, w_at: Column) -> Column:
        return F.struct(
            F.format_string("edge-%d", 2 * F.col("nth") + i).alias("name"), F.col(v).alias("v"), F.lit("+").alias("v_orient"), F.col(w).alias("w"), F.lit("+").alias("w_orient"),
            v_at.cast("long").alias("v_start"), v_at.cast("long").alias("v_end"), w_at.cast("long").alias("w_start"), w_at.cast("long").alias("w_end"), F.lit("*").alias("cigar"),
        )

    pair = F.array(edge(0, "p_ctg_id", "a_ctg_id", F.col("start"), F.lit(0)), edge(1, "a_ctg_id", "p_ctg_id", F.col("a_len"), F.col("end")))
    edges = with_len.withColumn("nth", nth).select(F.explode(pair).alias("e")).select("e.*")
    with_paths = lambda c, t: c.join(t.select(F.col("ctg_id").alias("t_id")).distinct(), F.col("name") == F.col("t_id"), "left_semi")
    nodes = with_paths(p_contigs, primary).select(*NODE_COLUMNS).unionByName(with_paths(a_contigs, alternatives).select(*NODE_COLUMNS))
    empty = nodes.sparkSession.createDataFrame([], "name string, nodes array<string>, cigars array<string>")
    return GfaGraph(checked_nodes(nodes), checked_edges(edges), empty)


def gfa1_lines(graph: GfaGraph) -> DataFrame:
    """``section, line``; sections in order H, S, L, P."""
    tab = lambda *c: F.concat_ws("\t", *c)
    cigar = F.when(F.col("cigar") == "*", F.concat(F.abs(F.col("w_end") - F.col("w_start")).cast("string"), F.lit("M"))).otherwise(F.col("cigar"))
    head = graph.nodes.sparkSession.createDataFrame([(0, "H\tVN:Z:1.0")], "section int, line string")
    s = graph.nodes.select(F.lit(1).alias("section"), tab(F.lit("S"), "name", "seq", F.concat(F.lit("LN:i:"), F.col("len").cast("string"))).alias("line"))
    link = graph.edges.select(F.lit(2).alias("section"), tab(F.lit("L"), F.when(F.col("name").isNotNull(), F.col("v")), "v_orient", "w", "w_orient", cigar).alias("line"))
    p = graph.paths.select(F.lit(3).alias("section"), tab(F.lit("P"), "name", F.array_join("nodes", ","), F.array_join("cigars", ",")).alias("line"))
    return head.unionByName(s).unionByName(link).unionByName(p)


def gfa2_lines(graph: GfaGraph) -> DataFrame:
    """``section, line``; sections in order H, S, E. A coordinate at a node's end carries a dollar sign."""
    tab = lambda *c: F.concat_ws("\t", *c)
    head = graph.nodes.sparkSession.createDataFrame([(0, "H\tVN:Z:2.0")], "section int, line string")
    s = graph.nodes.select(F.lit(1).alias("section"), tab(F.lit("S"), "name", F.col("len").cast("string"), "seq").alias("line"))
    v_len = graph.nodes.select(F.col("name").alias("v_name"), F.col("len").alias("v_len"))
    w_len = graph.nodes.select(F.col("name").alias("w_name"), F.col("len").alias("w_len"))
    met = graph.edges.join(v_len, F.col("v") == F.col("v_name")).join(w_len, F.col("w") == F.col("w_name"))
    at = lambda c, n: F.concat(F.col(c).cast("string"), F.when(F.col(c) == F.col(n), "$").otherwise(""))
    e = met.select(
        F.lit(2).alias("section"),
        tab(F.lit("E"), "name", F.concat("v", "v_orient"), F.concat("w", "w_orient"), at("v_start", "v_len"), at("v_end", "v_len"), at("w_start", "w_len"), at("w_end", "w_len"), "cigar").alias("line"),
    )
    return head.unionByName(s).unionByName(e)
