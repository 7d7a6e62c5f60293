"""The command line from reads and overlaps to contigs, tracks and graphs, each file read back."""

import random

import pytest

from strandmill.operators import assembly, graph
from strandmill.plans import cli
from strandmill.sources import readers as R
from strandmill.sources import sinks
from test_layout import laid_out

SIZE, STEP = 6000, 1500


def lines(path):
    return [line for p in sorted(path.glob("part-*")) for line in p.read_text().splitlines()]


def genome_files(tmp_path):
    rng = random.Random(8)
    genome = "".join(rng.choice("ACGT") for _ in range(24000))
    starts = list(range(0, 18001, STEP))
    fasta = "".join(f">{i:09d}\n{genome[s : s + SIZE]}\n" for i, s in enumerate(starts))
    rows = []
    for i, a in enumerate(starts):
        for j, b in enumerate(starts):
            n = SIZE - abs(a - b)
            if i != j and n > 2000:
                q_s, t_s = max(b - a, 0), max(a - b, 0)
                rows.append(f"{i:09d} {j:09d} {-n} 99.90 0 {q_s} {q_s + n} {SIZE} 0 {t_s} {t_s + n} {SIZE} overlap")
    (tmp_path / "reads.fa").write_text(fasta)
    (tmp_path / "reads.ovl").write_text("\n".join([*rows, "---", ""]))
    return genome, len(starts)


def test_reads_to_contigs_tracks_and_graphs(spark, tmp_path):
    genome, n_reads = genome_files(tmp_path)
    at = lambda name: str(tmp_path / name)
    asm = tmp_path / "asm"
    assert cli.main(["assemble", at("reads.ovl"), at("reads.fa"), str(asm), "--min-cov", "0", "--min-len", "1000"]) == 0
    kept = R.read_overlaps(spark, str(asm / "overlaps"), marker=True)
    assert kept.count() == len([x for x in lines(asm / "overlaps") if x != "---"]) > 0
    assert lines(asm / "chimeric_nodes") == []
    (primary,) = R.read_fasta(spark, str(asm / "primary")).collect()
    comp = str.maketrans("ACGT", "TGCA")
    assert primary.sequence in (genome, genome[::-1].translate(comp)) and "ctg_linear" in primary.name
    tiling = R.read_tiling_paths(spark, str(asm / "primary_tiling")).orderBy("ord").collect()
    assert tiling[0].ctg_id == primary.id and all(a.w == b.v for a, b in zip(tiling, tiling[1:]))
    for name in "alternative", "base":
        assert lines(asm / name) == lines(asm / f"{name}_tiling") == []

    (tmp_path / "map").write_text("".join(f"{i:09d} {i:09d} read/{i} {primary.id}\n" for i in range(n_reads)))
    assert cli.main(["track", at("reads.ovl"), at("map"), at("tracks"), "--by", "pid"]) == 0
    tracks = [x.split() for x in lines(tmp_path / "tracks")]
    assert {t[0] for t in tracks} == {f"{i:09d}" for i in range(n_reads)}
    assert all(t[1] == primary.id and t[3] == "0" and int(t[4]) < 0 and t[5] == "1" for t in tracks)

    files = [str(asm / x) for x in ("primary_tiling", "alternative_tiling")] + [at("reads.fa")] + [str(asm / x) for x in ("primary", "alternative", "edges")]
    files.append(at("reads.ovl"))
    assert cli.main(["collect-gfa", *files, at("plain"), "--write-reads"]) == 0
    assert cli.main(["collect-gfa", *files, at("full"), "--string-graph"]) == 0
    assert cli.main(["gfa", at("plain"), at("plain.gfa")]) == 0
    assert cli.main(["gfa", at("full"), at("full.gfa2"), "--version", "2"]) == 0
    plain = lines(tmp_path / "plain.gfa")
    on_path = {t.v[:9] for t in tiling} | {t.w[:9] for t in tiling}
    assert {x.split("\t")[1]: x.split("\t")[2] for x in plain if x[0] == "S"} == {r.id: r.sequence for r in R.read_fasta(spark, at("reads.fa")).collect() if r.id in on_path}
    assert sum(x[0] == "L" for x in plain) == len(tiling) and sum(x[0] == "P" for x in plain) == 1
    full = lines(tmp_path / "full.gfa2")
    live = {(e.v[:9], e.w[:9]) for e in R.read_edges(spark, str(asm / "edges")).filter("type = 'G'").collect()}
    added = [x.split("\t") for x in full if x[0] == "E"]
    assert {(x[2][:9], x[3][:9]) for x in added} == live and len({x[1] for x in added}) == len(added)

    (tmp_path / "none").write_text("other\n")
    assert cli.main(["collect-gfa", *files, at("empty"), "--only", at("none")]) == 0
    assert lines(tmp_path / "empty") == []


def test_six_outputs_of_a_bubble(spark, tmp_path):
    _, reads, by, _, contigs, tiling = laid_out(spark, random.Random(1), False)
    sequences = assembly.tiling_sequences(tiling, reads)
    sinks.write_contigs(sequences, contigs, tiling, assembly.alternative_contigs(sequences), str(tmp_path / "out"))
    read = lambda name: R.read_fasta(spark, str(tmp_path / "out" / name)).collect()
    # The last of three edges is the same in both.
    (primary,), (other,), (base,) = read("primary"), read("alternative"), read("base")
    assert other.id == "000000F-001-01" and base.id == "000000F-001-00"
    assert base.sequence in primary.sequence and len(base.sequence) == len(other.sequence) == 7800
    assert other.name.split()[3:] == ["7800", "900", "3", "0", "1.00", "0.33"] and base.name.split()[-3:] == ["0", "1.00", "1.00"]
    assert other.name.split()[1:3] == base.name.split()[1:3]
    paths = {name: R.read_tiling_paths(spark, str(tmp_path / "out" / f"{name}_tiling")).orderBy("ord").collect() for name in ("primary", "alternative", "base")}
    assert {p.ctg_id for p in paths["alternative"]} == {other.id} and {p.ctg_id for p in paths["base"]} == {base.id}
    assert all(a.w == b.v for rows in paths.values() for a, b in zip(rows, rows[1:]))
    proper = assembly.tiling_sequences(tiling, reads, proper=False, proper_alternatives=True).orderBy("bubble", "path").collect()
    assert [len(r.sequence) - len(s.sequence) for r, s in zip(proper, sequences.orderBy("bubble", "path").collect())] == [-3000, 3000, 3000]


def test_overlap_files_end_with_their_marker(spark, tmp_path):
    ddl = "q_id string, t_id string, score int, identity double, q_strand int, q_s int, q_e int, q_l int, t_strand int, t_s int, t_e int, t_l int, tag string"
    rows = [(f"{i:09d}", "000000001", -9, 99.5, 0, 0, 9, 9, 0, 0, 9, 9, "overlap") for i in range(10)]
    for name, some in (("some", rows), ("none", [])):
        sinks.write_overlaps(spark.createDataFrame(some, ddl).repartition(3), str(tmp_path / name), marker=True)
        for part in (tmp_path / name).glob("part-*"):
            assert part.read_text().splitlines()[-1:] in (["---"], [] if not some else None)
        assert R.read_overlaps(spark, str(tmp_path / name), marker=True).count() == len(some)
    sinks.write_overlaps(spark.createDataFrame(rows, ddl), str(tmp_path / "bare"))
    with pytest.raises(Exception, match="lacks its last line"):
        R.read_overlaps(spark, str(tmp_path / "bare"), marker=True).collect()


def test_blocks_tracks_and_lists(spark, tmp_path):
    (tmp_path / "db").write_text("files = 1\nblocks =  12\nsize = 3\nblocks = 4\n")
    (tmp_path / "bare").write_text("files = 1\n")
    assert R.block_count(R.read_lines(spark, str(tmp_path / "db"))) == 12
    assert R.block_count(R.read_lines(spark, str(tmp_path / "bare"))) == 1
    for name in ".raw.tan.anno", ".raw.rep1.anno", ".raw.rep1.data", ".other.tan.anno", "raw.x.anno":
        (tmp_path / name).write_text("")
    assert R.mask_tracks(spark, str(tmp_path), "raw") == ["rep1", "tan"]
    assert R.check_block_pairs(["x/b.las", "y/a.las", "a/d.las", "c.las"]) == ["y/a.las", "x/b.las", "c.las", "a/d.las"]
    with pytest.raises(ValueError, match="square"):
        R.check_block_pairs(["a", "b"])
    R.check_block_sequence([2, 1, 3, 3])
    R.check_block_sequence([])
    with pytest.raises(ValueError, match="numbered"):
        R.check_block_sequence([1, 3])
    (tmp_path / "list").write_text("a.fa\n\n/x/b.fa\n../c.fa\n")
    assert cli.main(["paths", str(tmp_path / "list"), str(tmp_path / "abs")]) == 0
    assert lines(tmp_path / "abs") == [f"{tmp_path}/a.fa", "/x/b.fa", f"{tmp_path.parent}/c.fa"]


def test_chimeric_nodes_of_a_string_graph(spark):
    ddl = "v string, w string, rid string, sp int, tp int, length int, score int, identity double"
    pairs = [("a", "n"), ("a", "x"), ("n", "b"), ("y", "b"), ("x", "x2"), ("y0", "y")]
    rows = [(f"{v}:E", f"{w}:E", w, 0, 9, 9, 5, 99.0) for v, w in pairs] + [(f"{w}:B", f"{v}:B", v, 9, 0, 9, 5, 99.0) for v, w in pairs]
    edges, nodes = graph.string_graph_and_chimeras(spark.createDataFrame(rows, ddl))
    assert {r.node for r in nodes.collect()} == {"n:E", "n:B"}
    assert {(r.v, r.w) for r in edges.filter("type = 'C'").collect()} == {("a:E", "n:E"), ("n:E", "b:E"), ("n:B", "a:B"), ("b:B", "n:B")}
    _, none = graph.string_graph_and_chimeras(spark.createDataFrame(rows, ddl), remove_chimeras=False)
    assert none.count() == 0
