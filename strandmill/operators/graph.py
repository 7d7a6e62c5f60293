"""String graph from overlaps: edges, transitive reduction, chimeras, spurs, best overlaps, edge types.

Edges are rows ``v, w, rid, sp, tp, length, score, identity``; nodes ``read:B`` and ``read:E``. Every edge (v, w) has a dual
(rev w, rev v). The order of iteration that sequential tools leave to chance is fixed here: by node names and keys.
Marks are tables of (v, w); steps that need all marks at once (spurs) work on the marks as they were before the step.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.functions.sequences import flip_end, reverse_path
from strandmill.operators import nodelists
from strandmill.operators.overlaps import first_per_pair
from strandmill.session import object_frame, release, settle, spill

# Fixed value: overhangs closer than this count as equal in transitive reduction.
FUZZ = 500


def overlap_edges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Two dual edges for each overlapping pair; of several overlaps of a pair only the first in order counts.

    rows: proper overlaps (``schema.OVERLAPS``) without contained reads. An overlap without overhang gives no edge.
    """
    first = first_per_pair(rows, "q_id", "t_id", order)
    turned = F.col("t_strand") == 1
    g_b, g_e = F.when(turned, F.col("t_e")).otherwise(F.col("t_s")), F.when(turned, F.col("t_s")).otherwise(F.col("t_e"))
    r = first.withColumn("g_b", g_b).withColumn("g_e", g_e)
    f, g = F.col("q_id"), F.col("t_id")
    f_b, f_e, f_l, g_b, g_e, g_l = (F.col(c) for c in ("q_s", "q_e", "q_l", "g_b", "g_e", "t_l"))

    def edge(v: Column, v_end: str, w: Column, w_end: str, read: Column, sp: Column, tp: Column) -> Column:
        return F.struct(
            F.concat(v, F.lit(f":{v_end}")).alias("v"), F.concat(w, F.lit(f":{w_end}")).alias("w"), read.alias("rid"),
            sp.cast("int").alias("sp"), tp.cast("int").alias("tp"), F.abs(sp - tp).cast("int").alias("length"),
        )

    zero = F.lit(0)
    same, ahead = g_b < g_e, f_b > 0
    pair = (
        F.when(ahead & same, F.when(g_e != g_l, F.array(edge(g, "B", f, "B", f, f_b, zero), edge(f, "E", g, "E", g, g_e, g_l))))
        .when(ahead, F.when(g_e != 0, F.array(edge(g, "E", f, "B", f, f_b, zero), edge(f, "E", g, "B", g, g_e, zero))))
        .when(same, F.when((g_b != 0) & (f_e != f_l), F.array(edge(f, "B", g, "B", g, g_b, zero), edge(g, "E", f, "E", f, f_e, f_l))))
        .otherwise(F.when((g_b != g_l) & (f_e != f_l), F.array(edge(f, "B", g, "E", g, g_b, g_l), edge(g, "B", f, "E", f, f_e, f_l))))
    )
    edges = r.select(F.explode(pair).alias("e"), (-F.col("score")).alias("score"), "identity", *[c.alias(f"o_{i}") for i, c in enumerate(order)])
    edges = edges.select("e.*", "score", "identity", *[f"o_{i}" for i in range(len(order))])
    # An edge that is given again keeps the last attributes.
    w = W.partitionBy("v", "w").orderBy(*[F.col(f"o_{i}").desc() for i in range(len(order))])
    return edges.withColumn("o_nth", F.row_number().over(w)).filter("o_nth = 1").select("v", "w", "rid", "sp", "tp", "length", "score", "identity")


def with_duals(marks: DataFrame) -> DataFrame:
    """Marks and the marks of the dual edges. An edge and its dual meet as the smaller of them, so each mark is shuffled once."""
    edge, dual = F.struct("v", "w"), F.struct(flip_end(F.col("w")).alias("v"), flip_end(F.col("v")).alias("w"))
    pairs = marks.select(F.when(edge <= dual, edge).otherwise(dual).alias("e")).select("e.v", "e.w").distinct()
    return pairs.select(F.explode(F.array_distinct(F.array(edge, dual))).alias("e")).select("e.v", "e.w")


def unmarked(edges: DataFrame, marks: DataFrame) -> DataFrame:
    return edges.join(marks.select(F.col("v").alias("m_v"), F.col("w").alias("m_w")), (F.col("v") == F.col("m_v")) & (F.col("w") == F.col("m_w")), "left_anti")


def two_hop_reduction(edges: DataFrame, fuzz: int = FUZZ) -> DataFrame:
    """Edges v -> x with a way v -> w -> x that is no longer than v's longest edge and ``fuzz``: the relational form.

    It judges every edge on its own, so it can mark more than the fold of :func:`transitive_edges`, which lets an edge that is
    itself marked reduce no other.
    """
    longest = W.partitionBy("v")
    first = edges.select("v", "w", "length", (F.max("length").over(longest) + fuzz).alias("most"))
    second = edges.select(F.col("v").alias("w2"), F.col("w").alias("x"), F.col("length").alias("length2"))
    direct = edges.select(F.col("v").alias("d_v"), F.col("w").alias("d_w"))
    ways = first.join(second, F.col("w") == F.col("w2")).filter(F.col("length") + F.col("length2") < F.col("most"))
    marks = ways.join(direct, (F.col("v") == F.col("d_v")) & (F.col("x") == F.col("d_w")), "left_semi")
    return marks.select("v", F.col("x").alias("w")).distinct()


def _redundant(own: np.ndarray, lengths: np.ndarray, lists: dict[bytes, tuple[bytes, bytes]], fuzz: int) -> np.ndarray:
    """Targets of one node that its other targets make redundant. own: the targets, in order of name and length; lists: packed targets of others."""
    names = nodelists.keys(own)
    fresh = np.concatenate([[True], names[1:] != names[:-1]])
    targets, nth = own[fresh], np.cumsum(fresh) - 1
    alive, most = np.ones(len(targets), bool), int(lengths.max()) + fuzz
    ahead = [(k, lists[w]) for k, w in enumerate(names[fresh].tolist()) if w in lists]
    hits: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    gone = []
    while ahead:  # the targets' own targets, as many at once as fit
        part, size = [], 0
        while ahead and size < nodelists.CHUNK:
            k, (packed, numbers) = ahead.pop()
            part.append((k, nodelists.unpack(packed), nodelists.unpack_numbers(numbers)))
            size += len(part[-1][2])
        both = nodelists.joined([targets, *(x for _, x, _ in part)])
        at = nodelists.binary(both[len(targets) :])
        at = pc.fill_null(pc.index_in(at, value_set=nodelists.binary(both[: len(targets)])), -1).to_numpy(zero_copy_only=False)
        begin = 0
        for k, _, second in part:
            x = at[begin : begin + len(second)]
            begin += len(second)
            mine = x >= 0
            near = mine & (second < fuzz)
            first = int(second.argmin())  # of the shortest the first by name
            near[first] = mine[first]
            gone.append(x[near])
            hits[k] = x[mine], second[mine]
    for row in np.argsort(lengths, kind="stable").tolist():
        k = int(nth[row])
        if k in hits and alive[k]:
            x, second = hits[k]
            alive[x[second < most - lengths[row]]] = False
    for x in gone:
        alive[x] = False
    return targets[~alive]


def transitive_edges(edges: DataFrame, fuzz: int = FUZZ) -> DataFrame:
    """``v, w`` of the redundant edges and their duals.

    Nodes are independent: each folds over its own edges and its targets' edges in order of length. Both come as packed lists, and neighbouring
    nodes share what they need. edges: ``v, w, length``; those without an end are left out, one without a length raises.
    """
    spark = edges.sparkSession
    lists = nodelists.target_lists(edges)
    release(spark)

    def run(nodes: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for v, _, names, more, held in nodes:
            found = _redundant(nodelists.unpack(names), nodelists.unpack_numbers(more), held, fuzz)
            if len(found):
                yield pa.RecordBatch.from_pydict({"v": pa.array([v], pa.string()), "names": pa.array([nodelists.pack(found)], pa.binary())})

    nodes = lists.select("block", "v", F.lit(None).cast("string").alias("avoid"), "names", F.col("lengths").alias("more"))
    marks = spill(nodelists.map_with_lists(nodes, lists, run, "v string, names binary"))
    release(spark)
    return with_duals(nodelists.unpacked(marks))


def degrees(edges: DataFrame, source: str = "v", sink: str = "w") -> DataFrame:
    """``node, out_degree, in_degree`` of every node."""
    ends = edges.select(F.col(source).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        edges.select(F.col(sink).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    )
    return ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def neighbourhood(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """``seed, node``: what each seed reaches within ``depth`` edges, itself included; never through ``avoid`` of its seed row.

    seeds: ``seed, avoid`` (``avoid`` may be null); null seeds and edges without an end are left out. What a seed has reached is a packed list until the last step.
    """
    spark = edges.sparkSession
    start = seeds.select("seed", "avoid").filter("seed IS NOT NULL").distinct()
    if depth < 1:
        return start.select("seed", "avoid", F.col("seed").alias("node"))
    lists = nodelists.target_lists(edges.select("v", "w", F.lit(0).alias("length")))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [nodelists.pack(nodelists.matrix(batch.column(0).slice(k, 1))) for k in range(batch.num_rows)]
            packed = pa.array(own, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, packed], ["v", "avoid", "names", "more"])

    def step(rows: Iterator[tuple], last: bool) -> Iterator[pa.RecordBatch]:
        for v, avoid, names, more, held in rows:
            known = nodelists.unpack(more)
            near = [nodelists.unpack(held[w][0]) for w in nodelists.keys(nodelists.unpack(names)).tolist() if w in held]
            every = nodelists.distinct(nodelists.joined([known, *near]))  # what was known stays ahead
            fresh = every[len(known) :]
            if avoid is not None:
                fresh = fresh[nodelists.keys(fresh) != avoid.encode()] if len(fresh) else fresh
            if last:
                yield from nodelists.arrays([(v, avoid, known), (v, avoid, fresh)])
                continue
            fresh = fresh[np.argsort(nodelists.keys(fresh))] if len(fresh) else fresh
            told = {"names": nodelists.pack(fresh), "more": nodelists.pack(nodelists.joined([known, fresh]))}
            yield pa.RecordBatch.from_pydict({"v": pa.array([v], pa.string()), "avoid": pa.array([avoid], pa.string())} | {c: pa.array([x], pa.binary()) for c, x in told.items()})

    packed = "v string, avoid string, names binary, more binary"
    rows = start.repartitionByRange("seed", "avoid").sortWithinPartitions("seed", "avoid").mapInArrow(begin, packed)
    for _ in range(depth - 1):
        rows = spill(rows.select(nodelists.block(), "v", "avoid", "names", "more"))
        release(spark)
        rows = nodelists.map_with_lists(rows, lists, lambda x: step(x, False), packed)
    rows = spill(rows.select(nodelists.block(), "v", "avoid", "names", "more"))
    release(spark)
    reached = nodelists.map_with_lists(rows, lists, lambda x: step(x, True), nodelists.ARRAYS)
    return reached.select(F.col("v").alias("seed"), "avoid", F.explode("nodes").alias("node"))


def chimeric_nodes(edges: DataFrame, marks: DataFrame, depth: int = 4) -> DataFrame:
    """``node``: branching-in and branching-out nodes whose forward sides never meet, with their reverse ends.

    A candidate n lies behind a branching node and before a merging one (live edges). Its targets and its sources' other
    targets (all edges) must be disjoint, and so must be what both reach within ``depth`` edges without n.
    """
    live = unmarked(edges, marks)
    deg = degrees(live)
    out_of_branch = live.join(deg.filter("out_degree >= 2").select(F.col("node").alias("b")), F.col("v") == F.col("b"), "left_semi").select(F.col("w").alias("n"))
    into_merge = live.join(deg.filter("in_degree >= 2").select(F.col("node").alias("b")), F.col("w") == F.col("b"), "left_semi").select(F.col("v").alias("n"))
    candidates = settle(out_of_branch.intersect(into_merge))
    targets = candidates.join(edges, F.col("n") == F.col("v")).select("n", F.col("w").alias("x"))
    back = candidates.join(edges, F.col("n") == F.col("w")).select("n", F.col("v").alias("source"))
    forward = edges.select(F.col("v").alias("f_v"), F.col("w").alias("x"))
    siblings = back.join(forward, F.col("source") == F.col("f_v")).select("n", "x").filter("x <> n").distinct()
    sides = settle(targets.withColumn("side", F.lit(1)).unionByName(siblings.withColumn("side", F.lit(2))).distinct())
    pairs = sides.select(F.col("x").alias("seed"), F.col("n").alias("avoid")).distinct()
    reached = neighbourhood(edges, pairs, depth).select("seed", "avoid", "node")
    flows = sides.join(reached, (F.col("x") == F.col("seed")) & (F.col("n") == F.col("avoid"))).select("n", "side", "node").distinct()
    met = flows.groupBy("n", "node").agg(F.count(F.lit(1)).alias("sides")).filter("sides > 1").select(F.col("n").alias("met"))
    chimeras = candidates.join(met, F.col("n") == F.col("met"), "left_anti")
    return chimeras.select(F.explode(F.array("n", flip_end(F.col("n")))).alias("node")).distinct()


def edges_at(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``v, w`` of all edges into or out of the nodes."""
    n = nodes.select(F.col("node").alias("a_node"))
    return edges.join(n, F.col("v") == F.col("a_node"), "left_semi").unionByName(edges.join(n, F.col("w") == F.col("a_node"), "left_semi")).select("v", "w").distinct()


def spur_edges(edges: DataFrame, marks: DataFrame) -> DataFrame:
    """``v, w``: live edges into dead ends from nodes with another live edge, and mirrored, with their duals.

    A dead end has no edge at all on its far side, marked or not. All are judged on the marks before the step.
    """
    live, every = unmarked(edges, marks), degrees(edges)
    deg = degrees(live)
    dead_out = every.filter("out_degree = 0").select(F.col("node").alias("d"))
    dead_in = every.filter("in_degree = 0").select(F.col("node").alias("d"))
    many_out = deg.filter("out_degree > 1").select(F.col("node").alias("m"))
    many_in = deg.filter("in_degree > 1").select(F.col("node").alias("m"))
    ahead = live.join(dead_out, F.col("w") == F.col("d"), "left_semi").join(many_out, F.col("v") == F.col("m"), "left_semi")
    behind = live.join(dead_in, F.col("v") == F.col("d"), "left_semi").join(many_in, F.col("w") == F.col("m"), "left_semi")
    return with_duals(ahead.unionByName(behind))


def best_edges(live: DataFrame) -> DataFrame:
    """``v, w, best_out, best_in``: is the edge its source's, its sink's best by score; ties go to the shorter overhang, then the name."""
    out = W.partitionBy("v").orderBy(F.col("score").desc(), "length", "w")
    into = W.partitionBy("w").orderBy(F.col("score").desc(), "length", "v")
    ranked = live.withColumn("r_out", F.row_number().over(out)).withColumn("r_in", F.row_number().over(into))
    return ranked.select("v", "w", (F.col("r_out") == 1).alias("best_out"), (F.col("r_in") == 1).alias("best_in"))


def not_best_edges(edges: DataFrame, marks: DataFrame) -> DataFrame:
    """``v, w``: live edges that are nobody's best, with their duals."""
    return with_duals(best_edges(unmarked(edges, marks)).filter("NOT best_out AND NOT best_in"))


def repeat_edges(edges: DataFrame, marks: DataFrame) -> DataFrame:
    """``v, w``: live edges that leave, or enter, beside a simple node by the local-flow rule.

    A simple node n has one live edge in, from a, and one out, to b. An edge a -> x (x not simple, more than one live edge in)
    goes if x and n share no target by any edge; mirrored, an edge y -> b (y not simple, more than one live edge out)
    goes if y and n share no source.
    """
    live = unmarked(edges, marks)
    deg = settle(degrees(live))
    simple = deg.filter("out_degree = 1 AND in_degree = 1").select(F.col("node").alias("n"))

    def side(rows: DataFrame, every: DataFrame, far: str) -> DataFrame:
        """rows, every: edges as (a, x); of a pair of siblings at a, one simple, the other goes."""
        kin = rows.join(simple, F.col("x") == F.col("n")).select("a", "n")
        others = rows.select(F.col("a").alias("o_a"), F.col("x"))
        crowded = deg.filter(F.col(far) > 1).select(F.col("node").alias("c"))
        pairs = kin.join(others, F.col("a") == F.col("o_a")).filter("x <> n").join(crowded, F.col("x") == F.col("c"), "left_semi")
        pairs = pairs.join(simple.select(F.col("n").alias("s")), F.col("x") == F.col("s"), "left_anti").select("a", "n", "x").distinct()
        nexts = every.select(F.col("a").alias("k_a"), F.col("x").alias("k_x"))
        shared = (
            pairs.join(nexts, F.col("n") == F.col("k_a"))
            .join(nexts.select(F.col("k_a").alias("l_a"), F.col("k_x").alias("l_x")), (F.col("x") == F.col("l_a")) & (F.col("k_x") == F.col("l_x")))
            .select("a", "n", "x")
            .distinct()
        )
        return pairs.exceptAll(shared).select("a", "x").distinct()

    ahead = side(live.select(F.col("v").alias("a"), F.col("w").alias("x")), edges.select(F.col("v").alias("a"), F.col("w").alias("x")), "in_degree")
    behind = side(live.select(F.col("w").alias("a"), F.col("v").alias("x")), edges.select(F.col("w").alias("a"), F.col("v").alias("x")), "out_degree")
    return ahead.select(F.col("a").alias("v"), F.col("x").alias("w")).unionByName(behind.select(F.col("x").alias("v"), F.col("a").alias("w"))).distinct()


def typed_edges(edges: DataFrame, reduced: DataFrame, chimeric: DataFrame, removed: DataFrame, spurs: DataFrame) -> DataFrame:
    """Edges with ``type``: G live, else C chimeric, R removed, S spur, TR transitive, the first that applies."""
    flags = (
        reduced.select("v", "w", F.lit("t").alias("f"))
        .unionByName(chimeric.select("v", "w", F.lit("c").alias("f")))
        .unionByName(removed.select("v", "w", F.lit("r").alias("f")))
        .unionByName(spurs.select("v", "w", F.lit("s").alias("f")))
        .groupBy(F.col("v").alias("f_v"), F.col("w").alias("f_w"))
        .agg(F.collect_set("f").alias("flags"))
    )
    met = edges.join(flags, (F.col("v") == F.col("f_v")) & (F.col("w") == F.col("f_w")), "left")
    has = lambda x: F.array_contains("flags", x)
    kind = F.when(F.col("flags").isNull(), "G").when(has("c"), "C").when(has("r"), "R").when(has("s"), "S").otherwise("TR")
    return met.withColumn("type", kind).drop("f_v", "f_w", "flags")


def string_graph(edges: DataFrame, remove_chimeras: bool = True, local_flow: bool = False) -> DataFrame:
    """Typed edges after transitive reduction, chimera, spur and best-overlap (or local-flow) removal."""
    return string_graph_and_chimeras(edges, remove_chimeras, local_flow)[0]


def string_graph_and_chimeras(edges: DataFrame, remove_chimeras: bool = True, local_flow: bool = False) -> tuple[DataFrame, DataFrame]:
    """The edges of ``string_graph`` and the chimeric nodes, ``node``."""
    edges = settle(edges)
    marks = reduced = settle(transitive_edges(edges))
    empty = edges.select("v", "w").limit(0)
    chimeric, nodes = empty, empty.select(F.col("v").alias("node"))
    if remove_chimeras:
        nodes = settle(chimeric_nodes(edges, marks))
        chimeric = settle(with_duals(edges_at(edges, nodes)))
        marks = settle(marks.unionByName(chimeric).distinct())
        chimeric = settle(chimeric.exceptAll(reduced))
    spurs = settle(spur_edges(edges, marks))
    marks = settle(marks.unionByName(spurs).distinct())
    removed = settle(repeat_edges(edges, marks) if local_flow else not_best_edges(edges, marks))
    marks = settle(marks.unionByName(removed).distinct())
    spurs = spurs.unionByName(spur_edges(edges, marks)).distinct()
    return typed_edges(edges, reduced, chimeric, removed, spurs), nodes


def repeat_bridges(unitigs: DataFrame, max_length: int = 60000) -> DataFrame:
    """``s, t, v`` of short unitigs between a merge-free branch and a branch-free merge, with their duals.

    unitigs: ``s, t, v, length``; the degrees count parallel unitigs.
    """
    deg = degrees(unitigs, "s", "t")
    a = deg.filter("in_degree = 1 AND out_degree = 2").select(F.col("node").alias("a"))
    b = deg.filter("in_degree = 2 AND out_degree = 1").select(F.col("node").alias("b"))
    found = unitigs.filter(F.col("length") < max_length).join(a, F.col("s") == F.col("a"), "left_semi").join(b, F.col("t") == F.col("b"), "left_semi")
    duals = found.select(flip_end(F.col("t")).alias("s"), flip_end(F.col("s")).alias("t"), flip_end(F.col("v")).alias("v"))
    return found.select("s", "t", "v").unionByName(duals).distinct()


def duplicate_paths(unitigs: DataFrame, max_nodes: int = 3) -> DataFrame:
    """``s, t, v`` of short simple unitigs beside another with the same ends; the smallest ``v`` stays. unitigs: with ``path`` array and ``type``."""
    short = unitigs.filter((F.col("type") == "simple") & (F.size("path") <= max_nodes))
    w = W.partitionBy("s", "t").orderBy("v")
    return short.withColumn("d_nth", F.row_number().over(w)).filter("d_nth > 1").select("s", "t", "v")


def edge_sequences(edges: DataFrame, reads: DataFrame) -> DataFrame:
    """Live edges with ``sequence``: the slice of their read, reverse-complemented where sp > tp. reads: ``id, sequence``."""
    from strandmill.functions.sequences import slice_sequence

    named = reads.select(F.col("id").alias("r_id"), F.col("sequence").alias("r_seq"))
    met = edges.filter(F.col("type") == "G").join(named, F.col("rid") == F.col("r_id"))
    return met.withColumn("sequence", slice_sequence(F.upper("r_seq"), F.col("sp"), F.col("tp"))).drop("r_id", "r_seq")


def simple_paths(live: DataFrame) -> DataFrame:
    """Unitigs: ``s, v, t, type, length, score, path`` of the maximal chains through nodes with one edge in and one out.

    Pointer jumping: every chain edge points at the next, and each round doubles what a pointer spans, so a chain of n edges
    takes log2 n rounds. Cycles without a way in begin at their smallest node; the rest of the chains at a node that
    isn't simple. live: ``v, w, length, score``.
    """
    edges = settle(live.select("v", "w", F.col("length").cast("long").alias("length"), F.col("score").cast("long").alias("score")))
    deg = degrees(edges).select("node", ((F.col("in_degree") == 1) & (F.col("out_degree") == 1)).alias("simple"))
    inner = deg.filter("simple").select(F.col("node").alias("n"))
    # What comes before an edge in its chain: the edge into its source, if that is simple.
    heads = edges.join(inner, F.col("v") == F.col("n"), "left").select("v", "w", F.col("n").isNotNull().alias("linked"))
    before = edges.select(F.col("v").alias("b_v"), F.col("w").alias("b_w"))
    links = heads.join(before, F.col("linked") & (F.col("v") == F.col("b_w")), "left").select("v", "w", F.col("b_v").alias("p_v"), F.when(F.col("b_v").isNotNull(), F.col("v")).alias("p_w"))
    # state: pointer (up) to an edge behind, steps to it, and the smallest node passed on the way
    state = settle(
        links.select(
            "v", "w", F.col("p_v").alias("u_v"), F.col("p_w").alias("u_w"), F.when(F.col("p_v").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.col("v").alias("low"), F.lit(False).alias("done")
        )
    )
    # Heads have no pointer. An edge that points at a head has arrived and is written once; only open edges go through the rounds. After r rounds
    # those within 2^r steps of their head have arrived: once as few are open, one round more leaves nothing but rings.
    heads, open_ = state.filter("u_v IS NULL"), state.filter("u_v IS NOT NULL")
    arrived, rounds, left, enough = [heads], 0, open_.count(), False
    while left and not enough:
        enough = (1 << rounds) >= left
        above = functools.reduce(DataFrame.unionByName, arrived, open_).select(
            F.col("v").alias("a_v"), F.col("w").alias("a_w"), F.col("u_v").alias("a_uv"), F.col("u_w").alias("a_uw"), F.col("steps").alias("a_steps"), F.col("low").alias("a_low"), F.col("done").alias("a_done")
        )
        met = open_.join(above, (F.col("u_v") == F.col("a_v")) & (F.col("u_w") == F.col("a_w")))
        at_head = F.col("a_uv").isNull()
        jumped = settle(
            met.select(
                "v", "w",
                F.when(at_head, F.col("u_v")).otherwise(F.col("a_uv")).alias("u_v"),
                F.when(at_head, F.col("u_w")).otherwise(F.col("a_uw")).alias("u_w"),
                (F.col("steps") + F.when(at_head, 0).otherwise(F.col("a_steps"))).alias("steps"),
                F.least("low", "a_low").alias("low"),
                (at_head | F.col("a_done")).alias("done"),
            )
        )
        arrived.append(jumped.filter("done"))
        open_ = jumped.filter("NOT done")
        rounds, left = rounds + 1, open_.count()
    state = functools.reduce(DataFrame.unionByName, arrived, open_)
    head = state.filter("u_v IS NULL").select(F.col("v").alias("h_v"), F.col("w").alias("h_w"), F.lit(True).alias("is_head"))
    placed = state.withColumn("t_v", F.coalesce("u_v", "v")).withColumn("t_w", F.coalesce("u_w", "w"))
    placed = placed.join(head, (F.col("t_v") == F.col("h_v")) & (F.col("t_w") == F.col("h_w")), "left")
    chains = placed.filter("is_head").select("v", "w", F.col("t_v").alias("c_v"), F.col("t_w").alias("c_w"), "steps")
    rings = _ordered_rings(placed.filter("is_head IS NULL").select("v", "w", "low"))
    rows = chains.unionByName(rings).join(edges.withColumnsRenamed({"v": "e_v", "w": "e_w"}), (F.col("v") == F.col("e_v")) & (F.col("w") == F.col("e_w")))
    grouped = rows.groupBy("c_v", "c_w").agg(
        F.sort_array(F.collect_list(F.struct("steps", "v", "w"))).alias("way"), F.sum("length").alias("length"), F.sum("score").alias("score")
    )
    path = F.concat(F.array(F.col("way")[0]["v"]), F.transform("way", lambda e: e["w"]))
    # Of a path and its dual the smaller one is told by its second node, the other by that node's flip.
    made = grouped.select(path.alias("path"), "length", "score")
    via = F.when(F.col("path") <= reverse_path(F.col("path")), F.col("path")[1]).otherwise(F.element_at("path", -2))
    return made.select(
        F.col("path")[0].alias("s"), via.alias("v"), F.element_at("path", -1).alias("t"), F.lit("simple").alias("type"), "length", "score", "path"
    )


def _ordered_rings(edges: DataFrame) -> DataFrame:
    """Edges of isolated cycles, ``v, w, low`` (the cycle's smallest node) -> ``v, w, c_v, c_w, steps``: places from the smallest node on."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        after = dict(zip(frame["v"], frame["w"], strict=True))
        v = first = frame["low"].iloc[0]
        out = []
        for k in range(len(after)):
            out.append((v, after[v], first, after[first], k))
            v = after[v]
        return object_frame(out, ["v", "w", "c_v", "c_w", "steps"])

    return edges.groupBy("low").applyInPandas(run, "v string, w string, c_v string, c_w string, steps long")


def dual_paths(unitigs: DataFrame) -> DataFrame:
    """Each simple unitig's dual: ends flipped, path reversed."""
    turned = unitigs.withColumn("path", reverse_path(F.col("path"))).withColumn("v", flip_end(F.col("v")))
    return turned.withColumn("s", F.col("path")[0]).withColumn("t", F.element_at("path", -1))
