"""Unitigs to contigs to sequences.

The greedy steps on the unitig graph work on connected components (both strands together), each in one task. A component is the
compressed graph of a piece of a genome: its size follows the number of branchings, not of reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.functions.sequences import alternative_name, contig_name, node_read, reverse_complement
from strandmill.kernels import unitigs as U
from strandmill.operators.align import contig_identities
from strandmill.operators.components import connected_components
from strandmill.session import object_frame, settle, ship_package

UNITIG_ROWS = "s string, v string, t string, type string, length long, score long, path array<string>"


def with_components(unitigs: DataFrame) -> DataFrame:
    """Adds ``component``: both strands of what is connected share one."""
    ends = unitigs.select(node_read(F.col("s")).alias("a"), node_read(F.col("t")).alias("b"))
    labels = connected_components(ends).select(F.col("node").alias("c_read"), F.col("label").alias("component"))
    return unitigs.join(labels, node_read(F.col("s")) == F.col("c_read")).drop("c_read")


def _graph(frame: pd.DataFrame) -> tuple[U.UnitigGraph, list[U.Edge]]:
    columns = zip(frame["s"], frame["t"], frame["v"], frame["length"], frame["score"], frame["path"], frame["type"], strict=True)
    return U.build(((s, t, v), U.Unitig(int(n), int(x), tuple(p), k)) for s, t, v, n, x, p, k in columns)


def _rows(graph: U.UnitigGraph) -> pd.DataFrame:
    rows = [(s, v, t, u.type, u.length, u.score, list(u.path)) for (s, t, v), u in sorted(graph.data.items())]
    return object_frame(rows, ["s", "v", "t", "type", "length", "score", "path"])


def simplify_unitigs(unitigs: DataFrame, spur_length: int = 50_000, late_spur_length: int = 80_000) -> DataFrame:
    """All unitigs and the compound ones, with ``type`` after spur, duplicate, bubble and bridge removal."""
    ship_package(unitigs.sparkSession)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        graph, _ = _graph(frame)
        U.simplify(graph, spur_length, late_spur_length)
        return _rows(graph)

    return with_components(unitigs).groupBy("component").applyInPandas(run, UNITIG_ROWS)


def remove_spurs(unitigs: DataFrame, spur_length: int) -> DataFrame:
    """Unitigs with spurs marked ``spur:2``."""
    ship_package(unitigs.sparkSession)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        graph, _ = _graph(frame)
        U.remove_spurs(graph, spur_length)
        return _rows(graph)

    return with_components(unitigs).groupBy("component").applyInPandas(run, UNITIG_ROWS)


def bubbles(unitigs: DataFrame) -> DataFrame:
    """``s, v, t, width, length, score, edges array<string>`` of the compound paths."""
    ship_package(unitigs.sparkSession)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        graph, _ = _graph(frame)
        rows = [
            (s, v, t, len(b.edges) / b.depth, b.length, b.score, [f"{a}~{x}~{z}" for a, z, x in sorted(b.edges)])
            for (s, t, v), b in sorted(U.compound_paths(graph).items())
        ]
        return object_frame(rows, ["s", "v", "t", "width", "length", "score", "edges"])

    schema = "s string, v string, t string, width double, length long, score long, edges array<string>"
    return with_components(unitigs).groupBy("component").applyInPandas(run, schema)


def contig_paths(unitigs: DataFrame, best_in: DataFrame | None = None) -> DataFrame:
    """``ctg_id, type, start_edge, end_node, length, score, utgs``: contigs by length, a forward and a reverse row each, then circles.

    unitigs: as from :func:`simplify_unitigs`; best_in: ``node, best`` the best read before a node. One row per contig is ranked.
    """
    ship_package(unitigs.sparkSession)
    labelled = with_components(unitigs)
    if best_in is None:
        best_in = unitigs.sparkSession.createDataFrame([], "node string, best string")
    last = labelled.select("component", F.col("t").alias("node")).distinct()
    hints = last.join(best_in, "node").groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("node", "best"))).alias("hints"))
    # One frame per component, the hints in its first row.
    ranked = labelled.join(hints, "component", "left").withColumn("nth", F.row_number().over(W.partitionBy("component").orderBy("s", "t", "v")))
    rows = ranked.withColumn("hints", F.when(F.col("nth") == 1, F.col("hints"))).drop("nth")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        graph, circles = _graph(frame)
        given = [h for h in frame["hints"] if h is not None and not (isinstance(h, float))]
        hints = dict(given[0]) if given else {}
        out = []
        for rank, forward, back in U.contigs(graph, hints):
            for strand, part in (("F", forward), ("R", back)):
                s, t, v = part[0]
                kind = "ctg_circular" if part[-1][1] == part[0][0] else "ctg_linear"
                out.append((
                    rank, "~".join(forward[0]), strand, kind, f"{s}~{v}~{t}", part[-1][1], sum(graph.data[e].length for e in part),
                    sum(graph.data[e].score for e in part), "|".join(f"{a}~{x}~{z}" for a, z, x in part),
                ))
        for s, t, v in sorted(circles):
            u = graph.data[(s, t, v)]
            out.append((-1, f"{s}~{t}~{v}", "C", "ctg_circular", f"{s}~{v}~{t}", t, u.length, u.score, f"{s}~{v}~{t}"))
        return object_frame(out, ["rank", "key", "strand", "type", "start_edge", "end_node", "length", "score", "utgs"])

    schema = "rank long, key string, strand string, type string, start_edge string, end_node string, length long, score long, utgs string"
    found = rows.groupBy("component").applyInPandas(run, schema)
    order = W.orderBy(F.col("rank").desc(), "key")
    numbered = found.withColumn("number", F.dense_rank().over(order) - 1)
    name = F.when(F.col("strand") == "C", F.format_string("%6d", F.col("number"))).when(F.col("strand") == "F", contig_name(F.col("number"))).otherwise(contig_name(F.col("number"), "R"))
    return numbered.select(F.trim(name).alias("ctg_id"), "type", "start_edge", "end_node", "length", "score", "utgs")


def laid_out(contigs: DataFrame) -> DataFrame:
    """One contig of each pair of opposite strands: the first by name."""
    start = F.split_part("start_edge", F.lit("~"), F.lit(1))
    flipped = lambda c: F.translate(c, "BE", "EB")
    here, there = F.concat_ws("~", start, "end_node"), F.concat_ws("~", flipped(F.col("end_node")), flipped(start))
    w = W.partitionBy(F.least(here, there)).orderBy("ctg_id")
    return contigs.withColumn("l_nth", F.row_number().over(w)).filter("l_nth = 1").drop("l_nth")


def tilings(contigs: DataFrame, unitigs: DataFrame, edges: DataFrame) -> DataFrame:
    """Tiling rows of primary paths and alternatives: ``ctg_id, bubble, path, ord, v, w, wrid, b, e, score, identity``.

    Primary rows have bubble and path 0. Bubbles of a contig count from 1, their paths from 0: path 0 is the one that
    the primary contig takes, the heaviest of the edge-disjoint cheapest paths. edges: live string-graph edges.
    """
    ship_package(contigs.sparkSession)
    parts = contigs.select("ctg_id", F.posexplode(F.split("utgs", r"\|")).alias("nth", "utg"))
    key = F.concat_ws("~", "s", "v", "t")
    known = unitigs.select(key.alias("u_key"), F.col("type").alias("u_type"), F.col("path").alias("u_path"))
    met = parts.join(known, F.col("utg") == F.col("u_key"))
    simple = met.filter("u_type <> 'compound'").select("ctg_id", "nth", F.lit(0).alias("path"), F.col("u_path").alias("nodes"))
    sub = met.filter("u_type = 'compound'").select("ctg_id", "nth", "utg", F.explode("u_path").alias("sub"))
    inner = sub.join(known.withColumnsRenamed({"u_key": "i_key", "u_path": "i_path"}).drop("u_type"), F.col("sub") == F.col("i_key"))
    steps = inner.select("ctg_id", "nth", "utg", F.explode(F.arrays_zip(F.slice("i_path", F.lit(1), F.size("i_path") - 1).alias("v"), F.slice("i_path", F.lit(2), F.size("i_path") - 1).alias("w"))).alias("e"))
    weights = edges.select(F.col("v").alias("e_v"), F.col("w").alias("e_w"), F.col("score").alias("e_score"))
    steps = steps.select("ctg_id", "nth", "utg", "e.v", "e.w").distinct().join(weights, (F.col("v") == F.col("e_v")) & (F.col("w") == F.col("e_w")))
    grouped = steps.groupBy("ctg_id", "nth", "utg").agg(F.collect_list(F.struct("v", "w", "e_score")).alias("steps"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for ctg, nth, utg, listed in zip(frame["ctg_id"], frame["nth"], frame["utg"], frame["steps"], strict=True):
                s, _, t = utg.split("~")
                found = U.disjoint_paths({(e["v"], e["w"]): int(e["e_score"]) for e in listed}, s, t)
                out += [(ctg, nth, i, nodes) for i, (_, nodes) in enumerate(found)]
            yield object_frame(out, ["ctg_id", "nth", "path", "nodes"])

    alternatives = grouped.mapInPandas(run, "ctg_id string, nth int, path int, nodes array<string>")
    numbered = alternatives.withColumn("bubble", F.dense_rank().over(W.partitionBy("ctg_id").orderBy("nth")))
    whole = W.partitionBy("ctg_id", "nth")
    several = numbered.withColumn("paths", F.count(F.lit(1)).over(whole)).filter("paths > 1")
    # Only bubbles with another path are numbered.
    several = several.withColumn("bubble", F.dense_rank().over(W.partitionBy("ctg_id").orderBy("nth")))
    primary = simple.unionByName(alternatives.filter("path = 0")).select("ctg_id", F.lit(0).alias("bubble"), F.lit(0).alias("path"), "nth", "nodes")
    rows = primary.unionByName(several.select("ctg_id", "bubble", "path", "nth", "nodes"))
    hops = rows.select("ctg_id", "bubble", "path", "nth", F.posexplode(F.arrays_zip(F.slice("nodes", F.lit(1), F.size("nodes") - 1).alias("v"), F.slice("nodes", F.lit(2), F.size("nodes") - 1).alias("w"))).alias("i", "e"))
    order = F.row_number().over(W.partitionBy("ctg_id", "bubble", "path").orderBy("nth", "i"))
    hops = hops.select("ctg_id", "bubble", "path", order.alias("ord"), "e.v", "e.w")
    full = edges.select(F.col("v").alias("x_v"), F.col("w").alias("x_w"), F.col("rid").alias("wrid"), F.col("sp").alias("b"), F.col("tp").alias("e"), "score", "identity")
    return hops.join(full, (F.col("v") == F.col("x_v")) & (F.col("w") == F.col("x_w"))).drop("x_v", "x_w")


def tiling_sequences(tiling: DataFrame, reads: DataFrame, proper: bool = True, proper_alternatives: bool = False) -> DataFrame:
    """``ctg_id, bubble, path, sequence, length, score, n_edges, first_node, last_node``: edge slices joined in order.

    ``proper`` puts the first read before a primary path that isn't circular, ``proper_alternatives`` before the paths of bubbles.
    reads: ``id, sequence``.
    """
    named = reads.select(F.col("id").alias("r_id"), F.upper("sequence").alias("r_seq"))
    met = tiling.join(named, F.col("wrid") == F.col("r_id"))
    from strandmill.functions.sequences import slice_sequence

    cut = met.withColumn("piece", slice_sequence(F.col("r_seq"), F.col("b"), F.col("e")))
    joined = cut.groupBy("ctg_id", "bubble", "path").agg(
        F.sort_array(F.collect_list(F.struct("ord", "piece"))).alias("pieces"),
        F.sum(F.abs(F.col("b") - F.col("e"))).alias("length"),
        F.sum("score").alias("score"),
        F.count(F.lit(1)).alias("n_edges"),
        F.min_by("v", "ord").alias("first_node"),
        F.max_by("w", "ord").alias("last_node"),
    )
    body = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    if not (proper or proper_alternatives):
        return joined.withColumn("sequence", body).drop("pieces")
    led = joined.join(named, node_read(F.col("first_node")) == F.col("r_id"), "left")
    lead = F.when(F.col("first_node").endswith(":E"), F.col("r_seq")).otherwise(reverse_complement(F.col("r_seq")))
    bare = F.when(F.col("bubble") == 0, F.lit(not proper)).otherwise(F.lit(not proper_alternatives))
    lead = F.when(bare | (F.col("first_node") == F.col("last_node")), F.lit("")).otherwise(lead)
    return led.withColumn("sequence", F.concat(lead, body)).drop("pieces", "r_id", "r_seq")


def named_tiling(tiling: DataFrame, kind: str) -> DataFrame:
    """Rows under the names that their sequences have: ``primary`` paths, ``alternative`` ones, or the ``base`` ones that alternatives lie beside."""
    rows = tiling.filter({"primary": "bubble = 0", "alternative": "bubble > 0 AND path > 0", "base": "bubble > 0 AND path = 0"}[kind])
    return rows if kind == "primary" else rows.withColumn("ctg_id", alternative_name(F.col("ctg_id"), F.col("bubble"), F.col("path")))


def base_contigs(sequences: DataFrame) -> DataFrame:
    """What the primary contigs have where alternatives lie: like ``alternative_contigs``, each equal to itself."""
    rows = sequences.filter("bubble > 0 AND path = 0").withColumn("name", alternative_name(F.col("ctg_id"), F.col("bubble"), F.col("path")))
    return rows.withColumn("delta_len", F.lit(0)).withColumn("identity", F.lit(1.0)).withColumn("coverage", F.lit(1.0))


def alternative_contigs(sequences: DataFrame) -> DataFrame:
    """Alternatives with ``name, delta_len, identity, coverage`` against path 0 of their bubble; short ones (2,000 bases) aren't aligned."""
    base = sequences.filter("bubble > 0 AND path = 0").select(F.col("ctg_id").alias("b_ctg"), F.col("bubble").alias("b_bubble"), F.col("sequence").alias("base_seq"))
    others = sequences.filter("bubble > 0 AND path > 0").withColumn("name", alternative_name(F.col("ctg_id"), F.col("bubble"), F.col("path")))
    met = settle(others.join(base, (F.col("ctg_id") == F.col("b_ctg")) & (F.col("bubble") == F.col("b_bubble"))).drop("b_ctg", "b_bubble"))
    long = met.filter((F.length("base_seq") > 2000) & (F.length("sequence") > 2000))
    judged = contig_identities(long.select(F.lit("").alias("base_id"), F.col("name").alias("other_id"), "base_seq", F.col("sequence").alias("other_seq")))
    judged = judged.select(F.col("other_id").alias("j_name"), "identity", "coverage")
    out = met.join(judged, F.col("name") == F.col("j_name"), "left").withColumn("delta_len", F.length("sequence") - F.length("base_seq"))
    return out.withColumn("identity", F.coalesce("identity", F.lit(0.0))).withColumn("coverage", F.coalesce("coverage", F.lit(0.0))).drop("base_seq", "j_name")


def distinct_alternatives(alternatives: DataFrame, max_identity: float = 96, max_coverage: float = 97, min_len_diff: int = 500) -> DataFrame:
    """Without those that are nearly the primary path: very identical, nearly fully covered and of about its length."""
    same = (100 * F.col("identity") > max_identity) & (100 * F.col("coverage") > max_coverage) & (F.abs("delta_len") < min_len_diff)
    return alternatives.filter(~same)


def unitig_sequences(unitigs: DataFrame, edges: DataFrame, reads: DataFrame, min_identity: float = 0.96, min_coverage: float = 0.98) -> DataFrame:
    """``name, length, score, sequence`` of simple unitigs, and of compound ones their heaviest path and the paths unlike it."""
    key = F.concat_ws("~", "s", "v", "t")
    as_contigs = unitigs.filter(F.col("type").isin("simple", "compound")).select(key.alias("ctg_id"), key.alias("utgs"), "length", "score", "type")
    sequences = settle(tiling_sequences(tilings(as_contigs, unitigs, edges), reads, proper=False))
    plain = sequences.filter("bubble = 0").select(F.concat("ctg_id", F.lit("-0")).alias("name"), "length", "score", "sequence")
    others = alternative_contigs(sequences).filter((F.col("identity") < min_identity) | (F.col("coverage") < min_coverage))
    nth = F.row_number().over(W.partitionBy("ctg_id").orderBy("path"))
    named = others.withColumn("nth", nth).select(F.concat("ctg_id", F.lit("-"), F.col("nth").cast("string")).alias("name"), "length", "score", "sequence")
    return plain.unionByName(named)


def path_nodes(contigs: DataFrame, unitigs: DataFrame) -> DataFrame:
    """``ctg_id, node``: all nodes of each contig, through compound unitigs' parts."""
    key = F.concat_ws("~", "s", "v", "t")
    known = unitigs.select(key.alias("u_key"), "type", "path")
    parts = contigs.select("ctg_id", F.explode(F.split("utgs", r"\|")).alias("utg")).join(known, F.col("utg") == F.col("u_key")).drop("u_key")
    inner = known.select(F.col("u_key").alias("i_key"), F.col("path").alias("i_path"))
    through = parts.filter("type = 'compound'").select("ctg_id", F.explode("path").alias("sub")).join(inner, F.col("sub") == F.col("i_key"))
    nodes = parts.filter("type <> 'compound'").select("ctg_id", F.explode("path").alias("node")).unionByName(through.select("ctg_id", F.explode("i_path").alias("node")))
    return nodes.distinct()


def node_map(memberships: DataFrame, node: str, group: str) -> DataFrame:
    """Inverted index: ``node, groups`` the sorted distinct groups of each node."""
    return memberships.groupBy(node).agg(F.array_sort(F.collect_set(group)).alias("groups"))


def pair_links(edges: DataFrame, memberships: DataFrame, node: str = "node", group: str = "ctg_id") -> DataFrame:
    """``g1, g2, links``: edges that lead from one group into another."""
    a = memberships.select(F.col(node).alias("a_node"), F.col(group).alias("g1"))
    b = memberships.select(F.col(node).alias("b_node"), F.col(group).alias("g2"))
    met = edges.select("v", "w").distinct().join(a, F.col("v") == F.col("a_node")).join(b, F.col("w") == F.col("b_node")).filter("g1 <> g2")
    return met.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("links"))


def boundary_links(contigs: DataFrame, unitigs: DataFrame, edges: DataFrame, ends: int = 5) -> DataFrame:
    """``ctg1, ctg2, utg1, utg2, links``: linked unitigs among the last five of one contig and the first five of another."""
    key = F.concat_ws("~", "s", "v", "t")
    known = unitigs.select(key.alias("u_key"), F.col("type").alias("u_type"), F.col("path").alias("u_path"))
    nodes = known.filter("u_type <> 'compound'").select(F.col("u_key").alias("utg"), F.explode("u_path").alias("node")).distinct()
    linked = pair_links(edges, nodes, "node", "utg")

    def side(parts, ctg: str, utg: str) -> DataFrame:
        rows = contigs.select(F.col("ctg_id").alias(ctg), F.explode(parts).alias("part")).join(known, F.col("part") == F.col("u_key"))
        return rows.select(ctg, F.explode(F.when(F.col("u_type") == "compound", F.col("u_path")).otherwise(F.array("part"))).alias(utg)).distinct()

    path = F.split("utgs", r"\|")
    last = side(F.slice(path, F.greatest(F.size(path) - ends + 1, F.lit(1)), F.lit(ends)), "ctg1", "utg1")
    first = side(F.slice(path, F.lit(1), F.lit(ends)), "ctg2", "utg2")
    met = linked.withColumnsRenamed({"g1": "l1", "g2": "l2"}).join(last, F.col("l1") == F.col("utg1")).join(first, F.col("l2") == F.col("utg2"))
    return met.filter("ctg1 <> ctg2").select("ctg1", "ctg2", "utg1", "utg2", "links")
