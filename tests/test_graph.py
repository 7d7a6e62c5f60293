"""String graph, unitigs, contigs: against plain loops and by invariants."""

import random

import pytest
from pyspark.sql import functions as F

from strandmill import schema
from strandmill.kernels import unitigs as U
from strandmill.operators import assembly, components, graph

EDGE = "v string, w string, rid string, sp int, tp int, length int, score int, identity double"


def flip(n):
    return n[:-1] + ("E" if n[-1] == "B" else "B")


def random_graph(rng, reads, n):
    """Random dual edge pairs."""
    out = {}
    for _ in range(n):
        a, b = rng.sample(range(reads), 2)
        v, w = f"{a:03d}:{rng.choice('BE')}", f"{b:03d}:{rng.choice('BE')}"
        score = rng.randint(500, 2000)
        out[v, w] = rng.randint(1, 1500), score
        out[flip(w), flip(v)] = rng.randint(1, 1500), score
    return out


def frame(spark, edges):
    return spark.createDataFrame([(v, w, w.split(":")[0], 0, n, n, s, 99.0) for (v, w), (n, s) in edges.items()], EDGE)


def pairs(df):
    return {(r[0], r[1]) for r in df.select("v", "w").collect()}


def loop_transitive(edges):
    out = {}
    for (v, w), (n, _) in edges.items():
        out.setdefault(v, []).append((n, w))
    for v in out:
        out[v].sort()
    gone = set()
    for v, targets in out.items():
        mark = {w: "inplay" for _, w in targets}
        most = targets[-1][0] + 500
        for n, w in targets:
            if mark[w] == "inplay":
                for n2, x in out.get(w, []):
                    if n + n2 < most and mark.get(x) == "inplay":
                        mark[x] = "gone"
        for n, w in targets:
            for i, (n2, x) in enumerate(out.get(w, [])):
                if (i == 0 or n2 < 500) and mark.get(x) == "inplay":
                    mark[x] = "gone"
        for w, m in mark.items():
            if m == "gone":
                gone |= {(v, w), (flip(w), flip(v))}
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_transitive_reduction_against_a_loop(spark, seed):
    edges = random_graph(random.Random(seed), 14, 60)
    df = frame(spark, edges)
    assert pairs(graph.transitive_edges(df)) == loop_transitive(edges)
    assert pairs(graph.two_hop_reduction(df)) <= set(edges)


def shuffled(spark):
    """Bytes that all stages so far have written for shuffles."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def layers(*sizes):
    """Every node of a layer has an edge to every node of each later one."""
    names = [[f"{k}{n:04d}:E" for n in range(size)] for k, size in enumerate(sizes)]
    return {(v, w): (10 * (k - j), 1) for j, a in enumerate(names) for k, b in enumerate(names) if j < k for v in a for w in b}


def test_reduction_does_not_shuffle_every_way(spark):
    edges = layers(60, 60, 120)
    df = frame(spark, edges).localCheckpoint()
    before = shuffled(spark)
    found = pairs(graph.transitive_edges(df))
    assert shuffled(spark) - before < 400_000  # 60 x 60 x 120 ways
    assert found == loop_transitive(edges)


def test_reduction_with_repeated_edges_and_names_of_unequal_length(spark):
    rows = [("a:E", "bb:E", 5), ("a:E", "bb:E", 700), ("bb:E", "c\u00e9c:E", 600), ("a:E", "c\u00e9c:E", 1100), ("a:E", "d:E", 1300), ("c\u00e9c:E", "d:E", 650), (None, "d:E", 1), ("a:E", None, 1)]
    df = spark.createDataFrame(rows, "v string, w string, length int")
    # a -> bb -> c\u00e9c is the first on bb's list, whatever its length; so is c\u00e9c -> d on c\u00e9c's.
    assert pairs(graph.transitive_edges(df)) == {("a:E", "c\u00e9c:E"), ("c\u00e9c:B", "a:B"), ("a:E", "d:E"), ("d:B", "a:B")}
    with pytest.raises(Exception, match="no length"):
        graph.transitive_edges(spark.createDataFrame([("a:E", "b:E", None)], df.schema))
    assert pairs(graph.transitive_edges(df.limit(0))) == set()


def loop_neighbourhood(edges, seeds, depth):
    found = set()
    for seed, avoid in seeds:
        reached = front = {seed}
        for _ in range(depth):
            front = {w for v, w in edges if v in front and w != avoid} - reached
            reached = reached | front
        found |= {(seed, avoid, node) for node in reached}
    return found


@pytest.mark.parametrize("depth", [0, 1, 2, 4])
def test_neighbourhood_against_a_loop(spark, depth):
    rng = random.Random(depth)
    names = [f"{'x' * rng.randint(0, 5)}{n}:{rng.choice('BE')}" for n in range(60)]
    edges = {(rng.choice(names), rng.choice(names)) for _ in range(110)}
    seeds = {(rng.choice([*names, "lone:E"]), rng.choice([None, *names])) for _ in range(200)} | {(names[0], names[0])}
    made = graph.neighbourhood(spark.createDataFrame([*edges, *edges], "v string, w string"), spark.createDataFrame([*seeds], "seed string, avoid string"), depth)
    rows = [tuple(r) for r in made.select("seed", "avoid", "node").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == loop_neighbourhood(edges, seeds, depth)


def test_neighbourhood_does_not_shuffle_every_way(spark):
    edges = layers(100, 100, 300)
    df = frame(spark, edges).select("v", "w").localCheckpoint()
    before = shuffled(spark)
    made = graph.neighbourhood(df, df.select(F.col("v").alias("seed"), F.lit(None).cast("string").alias("avoid")).distinct(), 2)
    assert made.count() == 100 * 401 + 100 * 301
    assert shuffled(spark) - before < 1_000_000  # 100 x 100 x 300 ways


def test_fixture_edges_of_all_four_orientations(spark):
    rows = [
        ("a", "b", -90, 99.0, 0, 10, 100, 100, 0, 0, 90, 120, "overlap"),
        ("a", "c", -90, 99.0, 0, 10, 100, 100, 1, 30, 120, 120, "overlap"),
        ("a", "d", -80, 99.0, 0, 0, 80, 100, 0, 40, 120, 120, "overlap"),
        ("a", "e", -80, 99.0, 0, 0, 80, 100, 1, 0, 80, 120, "overlap"),
        ("b", "a", -90, 99.0, 0, 0, 90, 120, 0, 10, 100, 100, "overlap"),
        ("a", "f", -80, 99.0, 0, 0, 100, 100, 0, 40, 120, 120, "overlap"),
    ]
    df = spark.createDataFrame(rows, schema.OVERLAPS)
    found = {(r.v, r.w): (r.rid, r.sp, r.tp, r.length, r.score) for r in graph.overlap_edges(df, [F.col("q_id"), F.col("t_id")]).collect()}
    assert found == {
        ("b:B", "a:B"): ("a", 10, 0, 10, 90), ("a:E", "b:E"): ("b", 90, 120, 30, 90),
        ("c:E", "a:B"): ("a", 10, 0, 10, 90), ("a:E", "c:B"): ("c", 30, 0, 30, 90),
        ("a:B", "d:B"): ("d", 40, 0, 40, 80), ("d:E", "a:E"): ("a", 80, 100, 20, 80),
        ("a:B", "e:E"): ("e", 80, 120, 40, 80), ("e:B", "a:E"): ("a", 80, 100, 20, 80),
    }
    assert {(flip(w), flip(v)) for v, w in found} == set(found)


@pytest.mark.parametrize("seed", range(3))
def test_string_graph_keeps_duality_and_types(spark, seed):
    edges = random_graph(random.Random(10 + seed), 16, 40)
    typed = {(r.v, r.w): r.type for r in graph.string_graph(frame(spark, edges)).collect()}
    assert set(typed) == set(edges)
    live = {e for e, t in typed.items() if t == "G"}
    assert {(flip(w), flip(v)) for v, w in live} == live
    assert {e for e, t in typed.items() if t != "G"} >= loop_transitive(edges) & set(edges)
    local = {(r.v, r.w): r.type for r in graph.string_graph(frame(spark, edges), False, True).collect()}
    assert set(local.values()) <= {"G", "R", "S", "TR"}


def test_spurs_and_best_edges(spark):
    edges = {("a:E", "b:E"): (5, 100), ("a:E", "x:E"): (5, 50), ("b:E", "c:E"): (5, 80)}
    edges |= {(flip(w), flip(v)): d for (v, w), d in list(edges.items())}
    df = frame(spark, edges)
    none = df.select("v", "w").limit(0)
    assert pairs(graph.spur_edges(df, none)) == {("a:E", "x:E"), ("x:B", "a:B")}
    best = {(r.v, r.w): (r.best_out, r.best_in) for r in graph.best_edges(df).collect()}
    assert best["a:E", "b:E"] == (True, True) and best["a:E", "x:E"] == (False, True)
    assert pairs(graph.not_best_edges(df, none)) == set()


def test_chimeras(spark):
    # Reads n bridges two loci: a,b -> n -> c,d with nothing else in common.
    ways = [("a", "n"), ("b", "n"), ("a", "p"), ("b", "p"), ("n", "c"), ("n", "d"), ("q", "c"), ("q", "d"), ("p", "r"), ("c", "s"), ("d", "s")]
    edges = {(f"{v}:E", f"{w}:E"): (5, 100) for v, w in ways}
    edges |= {(flip(w), flip(v)): d for (v, w), d in list(edges.items())}
    df = frame(spark, edges)
    none = df.select("v", "w").limit(0)
    assert {r.node for r in graph.chimeric_nodes(df, none).collect()} == {"n:E", "n:B"}


def test_simple_paths_chains_and_rings(spark):
    rng = random.Random(4)
    chain = [f"{i:03d}:E" for i in range(20)]
    ring = [f"{i:03d}:E" for i in (40, 45, 42, 41)]
    edges = {(a, b): (rng.randint(1, 9), 10) for a, b in zip(chain, chain[1:])}
    edges |= {(a, b): (2, 10) for a, b in zip(ring, ring[1:] + ring[:1])}
    edges[chain[7], "099:E"] = (3, 10)
    edges |= {(flip(w), flip(v)): d for (v, w), d in list(edges.items())}
    found = {tuple(r.path): (r.s, r.v, r.t, r.length, r.score) for r in graph.simple_paths(frame(spark, edges)).collect()}
    assert tuple(chain[:8]) in found and tuple(chain[7:]) in found and (chain[7], "099:E") in found
    loop = ("040:E", "045:E", "042:E", "041:E", "040:E")
    assert found[loop] == ("040:E", "041:E", "040:E", 8, 40)
    assert {(s, v, t) for s, v, t, *_ in found.values()} == {(flip(t), flip(v), flip(s)) for s, v, t, *_ in found.values()}
    assert {tuple(flip(n) for n in reversed(p)) for p in found} == set(found)
    used = [e for p in found for e in zip(p, p[1:])]
    assert len(used) == len(set(used)) and set(used) == set(edges)
    path = tuple(chain[:8])
    assert found[path][3] == sum(edges[e][0] for e in zip(path, path[1:]))


def test_simple_paths_of_every_length(spark):
    edges, lengths = [], [*range(1, 20), 31, 32, 33, 34]
    for n in lengths:
        edges += [(f"c{n}_{k:03d}:E", f"c{n}_{k + 1:03d}:E", 1, 1) for k in range(n)]
    rings = [2, 3, 4, 5, 8, 9]
    for n in rings:
        edges += [(f"r{n}_{k:03d}:E", f"r{n}_{(k + 1) % n:03d}:E", 1, 1) for k in range(n)]
    live = spark.createDataFrame(edges, "v string, w string, length long, score long")
    found = sorted((r.s, r.length) for r in graph.simple_paths(live).collect())
    assert found == sorted([(f"c{n}_000:E", n) for n in lengths] + [(f"r{n}_000:E", n) for n in rings])


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 260)]
    up = {n: n for e in edges for n in e}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    found = dict(tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {n: root(n) for n in up}


def unitig(s, v, t, length, score=10, kind="simple", path=None):
    return (s, v, t, kind, length, score, path or [s, v, t])


def with_duals(rows):
    out = list(rows)
    for s, v, t, kind, length, score, path in rows:
        out.append((flip(t), flip(v), flip(s), kind, length, score, [flip(n) for n in reversed(path)]))
    return out


def bubble_graph(spark):
    rows = [
        unitig("a:E", "x:E", "b:E", 90000, 500), unitig("b:E", "p:E", "c:E", 70000, 300, path=["b:E", "p:E", "p2:E", "p3:E", "c:E"]),
        unitig("b:E", "q:E", "c:E", 71000, 290, path=["b:E", "q:E", "q2:E", "q3:E", "c:E"]), unitig("c:E", "y:E", "d:E", 95000, 400),
    ]
    return spark.createDataFrame(with_duals(rows), assembly.UNITIG_ROWS)


def test_bubbles_become_compound_unitigs(spark):
    made = {(r.s, r.v, r.t): r for r in assembly.simplify_unitigs(bubble_graph(spark)).collect()}
    compound = made["b:E", "NA", "c:E"]
    assert compound.type == "compound" and sorted(compound.path) == ["b:E~p:E~c:E", "b:E~q:E~c:E"]
    assert ("c:B", "NA", "b:B") in made
    assert made["b:E", "p:E", "c:E"].type == "contained" and made["a:E", "x:E", "b:E"].type == "simple"
    found = assembly.bubbles(bubble_graph(spark)).collect()
    assert {(r.s, r.t, r.width) for r in found} == {("b:E", "c:E", 2.0), ("c:B", "b:B", 2.0)}


def test_contig_paths_use_each_edge_once(spark):
    contigs = assembly.contig_paths(assembly.simplify_unitigs(bubble_graph(spark))).collect()
    by = {r.ctg_id: r for r in contigs}
    assert set(by) == {"000000F", "000000R"}
    assert by["000000F"].utgs.split("|")[1].split("~")[1] == "NA" and by["000000F"].type == "ctg_linear"
    edges = [u for r in contigs for u in r.utgs.split("|")]
    assert len(edges) == len(set(edges)) == 6
    assert len(assembly.laid_out(spark.createDataFrame(contigs)).collect()) == 1


def test_spurs_go_and_circles_stay_apart(spark):
    rows = with_duals([
        unitig("a:E", "x:E", "b:E", 90000, path=["a:E", "x:E", "x2:E", "b:E"]), unitig("s:E", "y:E", "b:E", 100, path=["s:E", "y:E", "y2:E", "b:E"]),
        unitig("b:E", "z:E", "c:E", 90000, path=["b:E", "z:E", "z2:E", "c:E"]), unitig("k:E", "l:E", "k:E", 50),
    ])
    df = spark.createDataFrame(rows, assembly.UNITIG_ROWS)
    marked = {(r.s, r.t): r.type for r in assembly.remove_spurs(df, 50000).collect()}
    assert marked["s:E", "b:E"] == marked["b:B", "s:B"] == "spur:2" and marked["a:E", "b:E"] == "simple"
    contigs = assembly.contig_paths(assembly.simplify_unitigs(df)).collect()
    assert sorted(r.type for r in contigs) == ["ctg_circular", "ctg_circular", "ctg_linear", "ctg_linear"]


def test_duplicate_paths_and_bridges(spark):
    df = spark.createDataFrame(
        [unitig("a:E", "m:E", "b:E", 5), unitig("a:E", "k:E", "b:E", 5), unitig("a:E", "z:E", "b:E", 5, path=list("abcde"))], assembly.UNITIG_ROWS
    )
    assert [tuple(r) for r in graph.duplicate_paths(df).collect()] == [("a:E", "b:E", "m:E")]
    rows = [unitig("i:E", "1:E", "s:E", 9), unitig("s:E", "2:E", "t:E", 50), unitig("s:E", "3:E", "o:E", 9), unitig("j:E", "4:E", "t:E", 9), unitig("t:E", "5:E", "q:E", 9)]
    found = {tuple(r) for r in graph.repeat_bridges(spark.createDataFrame(rows, assembly.UNITIG_ROWS)).collect()}
    assert found == {("s:E", "t:E", "2:E"), ("t:B", "s:B", "2:B")}


def test_disjoint_paths_are_ordered_by_weight():
    edges = {("s", "a"): 1, ("a", "t"): 1, ("s", "b"): 5, ("b", "t"): 5, ("s", "t"): 4}
    assert U.disjoint_paths(edges, "s", "t") == [(10, ["s", "b", "t"]), (4, ["s", "t"]), (2, ["s", "a", "t"])]
    assert U.cheapest_path(edges, "t", "s") is None


def test_whole_assembly_of_a_simulated_genome(spark):
    rng = random.Random(6)
    genome = "".join(rng.choice("ACGT") for _ in range(30000))
    starts, size = list(range(0, 24001, 1500)), 6000
    comp = str.maketrans("ACGT", "TGCA")
    reads = {f"{i:09d}": genome[s : s + size] for i, s in enumerate(starts)}
    rows = []
    for i, a in enumerate(starts):
        for j, b in enumerate(starts):
            n = size - abs(a - b)
            if i != j and n > 2000:
                q_s, t_s = max(b - a, 0), max(a - b, 0)
                rows.append((f"{i:09d}", f"{j:09d}", -n, 99.9, 0, q_s, q_s + n, size, 0, t_s, t_s + n, size, "overlap"))
    from strandmill.plans.assembly import assemble
    from strandmill.plans.config import AssemblyConfig

    made = assemble(
        spark.createDataFrame(rows, schema.OVERLAPS), spark.createDataFrame(list(reads.items()), "id string, sequence string"),
        AssemblyConfig(min_cov=0, max_diff=100, max_cov=100, min_len=1000),
    )
    contigs = made.sequences.filter("bubble = 0").collect()
    assert len(contigs) == 1
    sequence = contigs[0].sequence
    assert sequence in (genome, genome[::-1].translate(comp))
    tiling = made.tiling.orderBy("ord").collect()
    assert all(a.w == b.v for a, b in zip(tiling, tiling[1:]))
    assert sum(abs(t.b - t.e) for t in tiling) == len(sequence) - size
    assert made.alternatives.count() == 0
