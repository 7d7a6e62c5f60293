"""Layout with bubbles, node maps, links, alignment operators."""

import random

from pyspark.sql import functions as F

from strandmill.operators import align, assembly, graph

EDGE = "v string, w string, rid string, sp int, tp int, length int, score int, identity double, type string"


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def bubble(spark, rng, other_like_base):
    """a -> b, then b -> p -> r -> c beside b -> q -> s -> c, then c -> d: each read's edge slice is its last part."""
    base = dna(rng, 2600)
    reads = {n: dna(rng, 3000) for n in "abpqrscd"}
    reads["p"] = reads["p"][:400] + base
    reads["q"] = reads["q"][:400] + (base[:1300] + "A" + base[1300:2599] if other_like_base else dna(rng, 2600))
    if other_like_base:
        reads["s"] = reads["r"]
    rows = []

    def edge(v, w, score):
        rows.append((f"{v}:E", f"{w}:E", w, 400, 3000, 2600, score, 99.0, "G"))
        rows.append((f"{w}:B", f"{v}:B", v, 2600, 0, 2600, score, 99.0, "G"))

    for v, w, score in (("a", "b", 500), ("b", "p", 400), ("p", "r", 400), ("r", "c", 400), ("b", "q", 300), ("q", "s", 300), ("s", "c", 300), ("c", "d", 500)):
        edge(v, w, score)
    return spark.createDataFrame(rows, EDGE), spark.createDataFrame(list(reads.items()), "id string, sequence string"), reads


def laid_out(spark, rng, alike):
    edges, reads, by = bubble(spark, rng, alike)
    unitigs = assembly.simplify_unitigs(graph.simple_paths(edges), 0, 0)
    contigs = assembly.contig_paths(unitigs)
    tiling = assembly.tilings(assembly.laid_out(contigs), unitigs, edges)
    return edges, reads, by, unitigs, contigs, tiling


def test_bubble_layout(spark):
    edges, reads, by, unitigs, contigs, tiling = laid_out(spark, random.Random(1), False)
    assert sorted(r.ctg_id for r in contigs.collect()) == ["000000F", "000000R"]
    sequences = assembly.tiling_sequences(tiling, reads, proper_alternatives=True)
    (primary,) = sequences.filter("bubble = 0").collect()
    forward = by["a"] + by["b"][400:] + by["p"][400:] + by["r"][400:] + by["c"][400:] + by["d"][400:]
    comp = str.maketrans("ACGT", "TGCA")
    backward = by["d"][::-1].translate(comp) + "".join(by[n][:2600][::-1].translate(comp) for n in "crpba")
    assert primary.sequence in (forward, backward)
    (other,) = assembly.alternative_contigs(sequences).collect()
    assert other.name == "000000F-001-01" and other.length == 7800 and other.score == 900 and other.identity == 0.0
    assert assembly.distinct_alternatives(assembly.alternative_contigs(sequences)).count() == 1
    improper = assembly.tiling_sequences(tiling, reads, proper=False).filter("bubble = 0").first()
    assert primary.sequence.endswith(improper.sequence) and len(primary.sequence) - len(improper.sequence) == 3000
    named = {r.name: r.length for r in assembly.unitig_sequences(unitigs, edges, reads).collect()}
    compound = [n for n in named if "~NA~" in n]
    assert sorted(n.rsplit("-", 1)[1] for n in compound) == ["0", "0", "1", "1"]


def test_alternatives_like_the_primary_path_go(spark):
    _, reads, _, _, _, tiling = laid_out(spark, random.Random(2), True)
    rows = assembly.alternative_contigs(assembly.tiling_sequences(tiling, reads, proper=False))
    (other,) = rows.collect()
    assert other.identity > 0.4 and abs(other.delta_len) < 500
    kept = assembly.distinct_alternatives(rows, max_identity=100 * other.identity - 1, max_coverage=100 * other.coverage - 1)
    assert kept.count() == 0


def test_nodes_links_and_boundaries(spark):
    edges, _, _, unitigs, contigs, _ = laid_out(spark, random.Random(3), False)
    nodes = assembly.path_nodes(contigs, unitigs)
    found = {(r.ctg_id, r.node) for r in nodes.collect()}
    strand = {c: {n for x, n in found if x == c} for c in ("000000F", "000000R")}
    assert sorted(len(v) for v in strand.values()) == [8, 8]
    index = {r.node: r.groups for r in assembly.node_map(nodes, "node", "ctg_id").collect()}
    assert all(len(g) == 1 for g in index.values()) and len(index) == 16
    two = spark.createDataFrame([("1F", "a:E"), ("1F", "b:E"), ("2F", "c:E"), ("2F", "b:E")], "ctg_id string, node string")
    ab = spark.createDataFrame([("a:E", "b:E"), ("b:E", "c:E"), ("a:E", "x:E")], "v string, w string")
    links = {(r.g1, r.g2): r.links for r in assembly.pair_links(ab, two).collect()}
    assert links == {("1F", "2F"): 2}
    u = spark.createDataFrame([("a:E", "b:E", "b:E", "simple", 1, 1, ["a:E", "b:E"]), ("c:E", "d:E", "d:E", "simple", 1, 1, ["c:E", "d:E"])], assembly.UNITIG_ROWS)
    c = spark.createDataFrame([("1F", "a:E~b:E~b:E"), ("2F", "c:E~d:E~d:E")], "ctg_id string, utgs string")
    bridge = spark.createDataFrame([("b:E", "c:E")], "v string, w string")
    assert [tuple(r) for r in assembly.boundary_links(c, u, bridge).collect()] == [("1F", "2F", "a:E~b:E~b:E", "c:E~d:E~d:E", 1)]


def test_edge_sequences(spark):
    edges, reads, by = bubble(spark, random.Random(4), False)
    rows = {(r.v, r.w): r.sequence for r in graph.edge_sequences(edges, reads).collect()}
    assert rows["a:E", "b:E"] == by["b"][400:3000]
    assert rows["b:B", "a:B"] == by["a"][0:2600][::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_seed_joins_and_alignments(spark):
    rng = random.Random(5)
    core = dna(rng, 1500)
    seqs = {"x": core, "y": dna(rng, 100) + core[:-50], "z": dna(rng, 1500), "n": "ACGTNNNN" * 3, "s": "ACG"}
    df = spark.createDataFrame(list(seqs.items()), "id string, sequence string")
    seeds = {(r.q_id, r.t_id, r.q_pos, r.t_pos) for r in align.seed_join(df, df, 12).collect()}
    k = 12
    table = {n: [(i, s[i : i + k]) for i in range(max(0, len(s) - k)) if set(s[i : i + k]) <= set("ACGT")] for n, s in seqs.items()}
    expected = {(a, b, i, j) for a in table for b in table for i, m in table[a] if i % 6 == 0 for j, o in table[b] if m == o}
    assert seeds == expected
    pairs = align.candidate_pairs(df, 12, 50, 20)
    assert [(r.q_id, r.t_id) for r in pairs.collect()] == [("x", "y")]
    told = pairs.join(df.select(F.col("id").alias("q_id"), F.col("sequence").alias("q_seq")), "q_id").join(df.select(F.col("id").alias("t_id"), F.col("sequence").alias("t_seq")), "t_id")
    (exact,) = align.align_pairs(told).collect()
    assert exact.score == 0 and exact.e1 - exact.s1 == exact.size and exact.s2 - exact.s1 == 100
    (sparse,) = align.align_pairs(told, "sparse").collect()
    assert sparse.score > 1000 and sparse.s2 - sparse.s1 == 100
    bins = {(r.q_id, r.t_id): r["count"] for r in align.diagonal_bins(align.seed_join(df, df, 12), 40).filter("q_id = 'x' AND t_id = 'y'").collect()}
    assert bins == {("x", "y"): len([1 for a, b, *_ in expected if (a, b) == ("x", "y")])}
    both = spark.createDataFrame([("x", "y", core, seqs["y"]), ("x", "z", core, seqs["z"]), ("x", "s", core, "")], "base_id string, other_id string, base_seq string, other_seq string")
    judged = {r.other_id: (r.identity, r.coverage) for r in align.contig_identities(both).collect()}
    assert judged["y"][0] > 0.99 and judged["z"] == judged["s"] == (0.0, 0.0)
