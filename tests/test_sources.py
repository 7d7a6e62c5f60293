"""Readers, sinks, GFA, configuration, streaming."""

import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from strandmill.operators import consensus, gfa, paths, stats
from strandmill.plans import config
from strandmill.sources import readers as R
from strandmill.sources import sinks as K


def write(path, text):
    path.write_text(text)
    return str(path)


def lines(path):
    return [line for p in sorted(path.glob("part-*")) for line in p.read_text().splitlines()]


def test_fasta(spark, tmp_path):
    a = write(tmp_path / "a.fa", ">r1 extra stuff\nACGT\nAC\n>r2\nTTTT\n")
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">r3/1 x\nGG\n\n")
    rows = {r.id: r for r in R.read_fasta(spark, [a, str(tmp_path / "b.fa.gz")]).collect()}
    assert (rows["r1"].name, rows["r1"].metadata, rows["r1"].sequence, rows["r1"].length) == ("r1 extra stuff", "extra stuff", "ACGTAC", 6)
    assert rows["r2"].metadata is None and rows["r3/1"].sequence == "GG"
    assert rows["r2"].md5 == __import__("hashlib").md5(b"TTTT").hexdigest()
    with pytest.raises(ValueError, match="Invalid FASTA"):
        R.read_fasta(spark, write(tmp_path / "bad.fa", "ACGT\n>x\nA\n"))
    with pytest.raises(ValueError, match="external tool"):
        R.read_fasta(spark, "x.dexta")


def test_fastq_and_sniffing(spark, tmp_path):
    text = "@m/7/0_4 q\nACGT\n+\n!!!!\n@m/8 z\nTT\n+\n!!\n"
    plain = write(tmp_path / "a.fastq", text)
    with bz2.open(tmp_path / "b.fq.bz2", "wt") as f:
        f.write(text)
    odd = write(tmp_path / "c.txt", text)
    assert sorted(r.sequence for r in R.read_sequences(spark, [plain, str(tmp_path / "b.fq.bz2"), odd]).collect()) == ["ACGT"] * 3 + ["TT"] * 3
    mixed = R.read_sequences(spark, [plain, write(tmp_path / "d.any", ">x\nA\n")])
    assert sorted(r.sequence for r in mixed.collect()) == ["A", "ACGT", "TT"]
    with pytest.raises(Exception, match="not a fastq"):
        R.read_fastq(spark, write(tmp_path / "e.fq", "x\nA\n+\n!\n")).collect()


def test_headers(spark):
    rows = spark.createDataFrame([(0, "mine/123/5_9 foo bar", "ACGT"), (1, "mine/5/5_7", "ACGT"), (2, "mine/6/x", "AC")], "ord int, name string, sequence string")
    parsed = [(r.movie, r.zmw, r.extra) for r in R.parsed_headers(rows).orderBy("ord").collect()]
    assert parsed == [("mine", 123, "5_9 foo bar"), ("mine", 5, "5_7"), ("mine", 6, "x")]
    named = [r.name for r in R.reheadered(R.parsed_headers(rows)).collect()]
    assert named == ["mine/123/5_9 foo bar", "mine/5/5_9", "mine/6/0_2 x"]
    counted = R.parsed_headers(spark.createDataFrame([(0, "mine foo bar", "A"), (1, "m b", "C")], "ord int, name string, sequence string"), counter_from=1)
    assert [(r.movie, r.zmw, r.extra) for r in counted.orderBy("ord").collect()] == [("mine", 1, "foo bar"), ("m", 2, "b")]


OVL = "000000001 000000002 -50 99.50 0 0 50 50 0 0 50 1988 overlap x y\n000000003 000000004 -9 80.00 0 1 9 50 1 0 50 1988 none\n"


def test_overlaps_with_and_without_marker(spark, tmp_path):
    good = write(tmp_path / "a.ovl", OVL + "---\nafter 1 2\n")
    rows = R.read_overlaps(spark, good, marker=True).orderBy("ord").collect()
    assert [(r.q_id, r.score, r.identity, r.tag) for r in rows] == [("000000001", -50, 99.5, "overlap"), ("000000003", -9, 80.0, "none")]
    bad = write(tmp_path / "b.ovl", OVL)
    assert R.read_overlaps(spark, bad).count() == 2
    with pytest.raises(Exception, match="lacks its last line"):
        R.read_overlaps(spark, bad, marker=True).collect()
    K.write_overlaps(R.read_overlaps(spark, bad), str(tmp_path / "out"))
    assert sorted(lines(tmp_path / "out"))[0] == OVL.splitlines()[0][: -len(" x y")]


def test_graph_tables(spark, tmp_path):
    edges = R.read_edges(spark, write(tmp_path / "e", "a:B b:B b 9 0 1980 99.95 G\nshort line\n"))
    assert [tuple(r) for r in edges.collect()] == [("a:B", "b:B", "b", 9, 0, 1980, 99.95, "G")]
    assert K.edge_text(edges).first()[0] == "a:B b:B b     9     0  1980 99.95 G"
    unitigs = R.read_unitigs(spark, write(tmp_path / "u", "a:B b:B c:B simple 10 20 a:B~b:B~c:B\nc:B NA e:B compound 5 6 c:B~x:B~e:B|c:B~y:B~e:B\n"))
    assert sorted(r.value for r in K.unitig_text(unitigs).collect()) == ["a:B b:B c:B simple 10 20 a:B~b:B~c:B", "c:B NA e:B compound 5 6 c:B~x:B~e:B|c:B~y:B~e:B"]
    contigs = R.read_contigs(spark, write(tmp_path / "c", "0F ctg_linear a:B~b:B~c:B e:B 15 26 a:B~b:B~c:B|c:B~NA~e:B\n"))
    assert {(r.s, r.v, r.t) for r in R.unitig_contigs(contigs, unitigs).collect()} == {("a:B", "b:B", "c:B"), ("c:B", "x:B", "e:B"), ("c:B", "y:B", "e:B")}
    assert K.contig_text(contigs).first()[0].startswith("0F ctg_linear a:B~b:B~c:B e:B 15 26")
    tiling = write(tmp_path / "t", "1F a:B b:B b 9 0 1 99.5\n\n1F b:B c:B c 5 0 1 99.5\n2F x:B y:B y 1 0 1 9\n")
    keep = spark.createDataFrame([("1F",), ("zz",)], "ctg_id string")
    assert [(r.ctg_id, r.ord, r.w) for r in R.read_tiling_paths(spark, tiling, keep).orderBy("ord").collect()] == [("1F", 1, "b:B"), ("1F", 2, "c:B")]


def test_dumps_and_histograms(spark):
    rows = ["+ R 3", "R 0", "H 3 abc", "L 11 0 2000", "R 1", "L 12 500 2500", "R 2", "L 13 0 2500"]
    df = spark.createDataFrame(list(enumerate(rows)), "ord int, line string")
    assert [r.length for r in R.dump_lengths(df).orderBy("ord").collect()] == [2000, 2000, 2500]
    assert {r.id: r.length for r in R.keyed_dump_lengths(df).collect()} == {0: 2000, 1: 2000, 2: 2500}
    text = ["  Bin:  Count  % Reads  % Bases  Average", "   4:  2  25.0  40.0  4", "  3: 0 25 40 0", "  1,002:  3  62.5  70.0  1,002", "noise"]
    found = R.stats_histogram(spark.createDataFrame([(x,) for x in text], "line string")).collect()
    assert sorted(tuple(r) for r in found) == [(3, 0), (4, 2), (1002, 3)]
    pairs = R.two_integer_columns(spark.createDataFrame([("100 1",), (" ",), ("200 2",), ("100 5",)], "line string"))
    assert [tuple(r) for r in pairs.collect()] == [(100, 1), (200, 2), (100, 5)]
    assert stats.weighted_average(pairs, "b", "a").first()[0] == 2.5
    files = spark.createDataFrame([("raw.2.raw.1.las",), ("raw.1.raw.2.las",), ("raw.1.raw.1.las",)], "file string")
    assert {r.block: r.files for r in R.las_blocks(files).collect()} == {1: ["raw.1.raw.1.las", "raw.1.raw.2.las"], 2: ["raw.2.raw.1.las"]}


def test_fofn_and_find(spark, tmp_path):
    (tmp_path / "d").mkdir()
    a, b = write(tmp_path / "a.fa", ">a\nA\n"), write(tmp_path / "d" / "b.fa", ">b\nC\n")
    fofn = write(tmp_path / "x.fofn", f"./a.fa\n\n{b}\n")
    assert R.read_fofn(spark, fofn) == [a, b]
    assert R.read_fofn(spark, write(tmp_path / "x.json", json.dumps(["d/b.fa"]))) == [b]
    (tmp_path / "empty.fa").touch()
    with pytest.raises(ValueError, match="Empty or missing"):
        R.read_fofn(spark, write(tmp_path / "y.fofn", "empty.fa\n"))
    assert [p.rsplit("/", 1)[-1] for p in R.find_files(spark, str(tmp_path), "*.fa")][:2] == ["a.fa", "b.fa"]
    assert R.read_json_value(spark, str(tmp_path / "x.json")) == ["d/b.fa"]


def test_fasta_sinks(spark, tmp_path):
    df = spark.createDataFrame([("r1", "A" * 130, "m1"), ("r2", "CC", "m2")], "name string, sequence string, movie string")
    K.write_fasta(df, str(tmp_path / "f"))
    assert R.read_fasta(spark, str(tmp_path / "f")).select("name", "sequence").orderBy("name").collect() == df.select("name", "sequence").collect()
    assert sorted(map(len, lines(tmp_path / "f"))) == [2, 3, 3, 10, 60, 60]
    K.write_fasta_by(df, "movie", str(tmp_path / "g"), gzip=True)
    assert sorted(p.name for p in (tmp_path / "g").glob("movie=*")) == ["movie=m1", "movie=m2"]


def small_graph(spark):
    nodes = spark.createDataFrame([("node1", 7, "ACTGAAA"), ("node2", 10, "AAACCCGGGT")], "name string, len long, seq string")
    edges = spark.createDataFrame([("edge1", "node1", "+", "node2", "+", 4, 7, 0, 3, "*")], "name string, v string, v_orient string, w string, w_orient string, v_start long, v_end long, w_start long, w_end long, cigar string")
    ways = spark.createDataFrame([("000000F", ["node1", "node2"], ["4M", "7M"])], "name string, nodes array<string>, cigars array<string>")
    return gfa.GfaGraph(nodes, edges, ways)


def test_gfa_text(spark, tmp_path):
    graph = small_graph(spark)
    one = [r.line for r in gfa.gfa1_lines(graph).orderBy("section", "line").collect()]
    assert one == ["H\tVN:Z:1.0", "S\tnode1\tACTGAAA\tLN:i:7", "S\tnode2\tAAACCCGGGT\tLN:i:10", "L\tnode1\t+\tnode2\t+\t3M", "P\t000000F\tnode1,node2\t4M,7M"]
    two = [r.line for r in gfa.gfa2_lines(graph).orderBy("section", "line").collect()]
    assert two == ["H\tVN:Z:2.0", "S\tnode1\t7\tACTGAAA", "S\tnode2\t10\tAAACCCGGGT", "E\tedge1\tnode1+\tnode2+\t4\t7$\t0\t3\t*"]
    K.write_gfa_json(graph, str(tmp_path / "j"))
    back = K.read_gfa_json(spark, str(tmp_path / "j"))
    assert back.nodes.orderBy("name").collect() == graph.nodes.collect() and back.edges.collect() == graph.edges.collect() and back.paths.collect() == graph.paths.collect()
    assert "('node1', 'node2')" in {r.key for r in K.gfa_json_rows(graph).collect()}
    K.write_gfa1(graph, str(tmp_path / "g1"))
    assert lines(tmp_path / "g1") == one


@pytest.mark.parametrize(
    "column,value,message",
    [
        ("name", "", "name is empty"), ("v", "", "v is empty"), ("w", "", "w is empty"), ("v_orient", "x", "v_orient is neither"), ("w_orient", "x", "w_orient is neither"),
        ("v_start", -1, "v_start is negative"), ("w_start", -1, "w_start is negative"), ("v_end", 2, "v_start lies behind v_end"), ("w_start", 9, "w_start lies behind w_end"),
        ("cigar", "", "cigar is empty"),
    ],
)
def test_bad_edges_raise(spark, column, value, message):
    with pytest.raises(Exception, match=message):
        gfa.checked_edges(small_graph(spark).edges.withColumn(column, F.lit(value))).collect()


def test_bad_nodes_and_paths_raise(spark):
    graph = small_graph(spark)
    for column, value, message in (("name", "", "name is empty"), ("len", -1, "len is negative"), ("seq", "", "seq is empty")):
        with pytest.raises(Exception, match=message):
            gfa.checked_nodes(graph.nodes.withColumn(column, F.lit(value))).collect()
    with pytest.raises(Exception, match="one CIGAR for each node"):
        gfa.checked_paths(graph.paths.withColumn("nodes", F.array(F.lit("x")))).collect()
    with pytest.raises(Exception, match="one node at least"):
        gfa.checked_paths(graph.paths.withColumn("nodes", F.array().cast("array<string>"))).collect()


TILING = "ctg_id string, v string, w string, wrid string, b int, e int, score int, identity double, ord int"


def test_contig_graph(spark):
    p = spark.createDataFrame([("0F", "a:B", "b:B", "b", 100, 0, 1, 9.0, 1), ("0F", "b:B", "c:B", "c", 50, 0, 1, 9.0, 2), ("2F", "x:B", "y:B", "y", 30, 0, 1, 9.0, 1)], TILING)
    a = spark.createDataFrame([("0F-001", "a:B", "k:B", "k", 9, 0, 1, 9.0, 1), ("0F-001", "k:B", "c:B", "c", 9, 0, 1, 9.0, 2)], TILING)
    contigs = spark.createDataFrame([("0F", 170, "*"), ("2F", 30, "*")], "name string, len int, seq string")
    alts = spark.createDataFrame([("0F-001", 18, "*")], "name string, len int, seq string")
    graph = gfa.contig_graph(p, a, contigs, alts)
    assert sorted(r.name for r in graph.nodes.collect()) == ["0F", "0F-001", "2F"]
    assert [tuple(r) for r in graph.edges.orderBy("name").collect()] == [("edge-0", "0F", "+", "0F-001", "+", 20, 20, 0, 0, "*"), ("edge-1", "0F-001", "+", "0F", "+", 18, 18, 170, 170, "*")]
    only = gfa.contig_graph(p, a, contigs, alts, spark.createDataFrame([("2F",)], "ctg_id string"))
    assert [r.name for r in only.nodes.collect()] == ["2F"] and only.edges.count() == 0


def test_tiling_graph(spark):
    rows = [("a", "b", -60, 99.0, 0, 40, 100, 100, 1, 10, 70, 80, "overlap", 0)]
    ddl = "q_id string, t_id string, score int, identity double, q_strand int, q_s int, q_e int, q_l int, t_strand int, t_s int, t_e int, t_l int, tag string, ord int"
    pairs = gfa.pread_overlap_pairs(spark.createDataFrame(rows, ddl), "ord")
    assert {(r.q_id, r.t_id, r.q_s, r.t_s, r.q_strand) for r in pairs.collect()} == {("a", "b", 40, 10, 0), ("b", "a", 10, 40, 1)}
    located = paths.path_coordinates(spark.createDataFrame([("0F", "a:E", "b:B", "b", 20, 0, 60, 99.0, 1)], TILING))
    reads = spark.createDataFrame([("a", 100, "*"), ("b", 80, "*"), ("zz", 5, "*")], "name string, len int, seq string")
    graph = gfa.tiling_graph(located, reads, pairs)
    assert tuple(graph.edges.first()) == ("edge-0", "a", "+", "b", "-", 40, 100, 10, 70, "*")
    assert tuple(graph.paths.first()) == ("0F", ["a", "b"], ["0M", "20M"]) and graph.nodes.count() == 2
    with pytest.raises(Exception, match="no overlap of"):
        gfa.tiling_graph(located, reads, pairs.filter("q_id = 'zz'")).edges.collect()


PILES = ["s1 ACGT", "r2 ACG", "+ +", "s2 AC", "* *", "three word line", "s3 GG", "s3 GG", "r4 TTTTT", "+ +", "open AC", "- -", "late AC", "+ +"]


def test_piles(spark):
    df = spark.createDataFrame([("x", i, line) for i, line in enumerate(PILES)], "stream string, ord long, line string")
    rows = consensus.pile_rows(df)
    assert sorted((r.pile, r.read_id) for r in rows.collect()) == [(0, "r2"), (0, "s1"), (2, "r4"), (2, "s3"), (2, "s3")]
    accepted = consensus.piles(rows, consensus.ConsensusConfig(min_n_read=3, min_cov_aln=1))
    assert sorted((r.seed_id, r.reads) for r in accepted.collect()) == [("s1", ["ACGT", "ACG"]), ("s3", ["TTTTT", "GG"])]
    assert consensus.piles(rows, consensus.ConsensusConfig(min_n_read=4, min_cov_aln=1)).count() == 0


def test_consensus_records(spark):
    found = spark.createDataFrame([("x", 0, "000000012", "a" + "A" * 600 + "c" + "CG" * 400 + "t" + "G" * 10)], "stream string, pile long, seed_id string, consensus string")
    assert [(r.name, len(r.sequence)) for r in consensus.region_records(found).collect()] == [("prolog/0000000120/0_600", 600), ("prolog/0000000121/0_800", 800)]
    assert [(r.name, len(r.sequence)) for r in consensus.longest_records(found).collect()] == [("000000012", 800)]
    assert consensus.full_records(found).first().name == "000000012_f"


def test_piles_from_reads_to_consensus(spark):
    import random

    rng = random.Random(2)
    truth = "".join(rng.choice("ACGT") for _ in range(900))
    noisy = lambda: "".join(b for b in truth if rng.random() > 0.04)
    text = [f"seed {noisy()}"] + [f"r{i} {noisy()}" for i in range(14)] + ["+ +"]
    df = spark.createDataFrame([("x", i, line) for i, line in enumerate(text)], "stream string, ord long, line string")
    config_ = consensus.ConsensusConfig(min_cov=3, min_n_read=5, min_cov_aln=2)
    (made,) = consensus.longest_records(consensus.pile_consensuses(consensus.piles(consensus.pile_rows(df), config_), config_)).collect()
    assert made.sequence[50:-50] in truth


def test_streamed_piles_are_the_batch_ones(spark, tmp_path):
    from strandmill.streaming.piles import closed_piles

    schema = "stream string, ord long, line string"
    rows = [("x", i, line) for i, line in enumerate(PILES)] + [("y", i, line) for i, line in enumerate(["a AA", "+ +", "b CC"])]
    for k in range(0, len(rows), 5):
        spark.createDataFrame(rows[k : k + 5], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "in"))
    query = closed_piles(stream).writeStream.format("memory").queryName("piles").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    batch = consensus.pile_rows(spark.createDataFrame(rows, schema))
    columns = ["stream", "pile", "ord", "read_id", "sequence"]
    assert sorted(map(tuple, spark.table("piles").select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


def test_configuration():
    assert [config.as_bool(x) for x in ("T", "y", "1", 3, "true")] == [True] * 5
    assert [config.as_bool(x) for x in ("F", "n", "0", 0, "False")] == [False] * 5
    with pytest.raises(ValueError):
        config.as_bool("maybe")
    assert config.from_mapping({"bestn": "7", "local_flow": "yes", "min_identity": "95.5"}) == config.AssemblyConfig(bestn=7, local_flow=True, min_identity=95.5)
    with pytest.raises(ValueError, match="unknown settings"):
        config.from_mapping({"nope": 1})
    with pytest.raises(ValueError, match="unknown section"):
        config.check_sections({"General": {}, "Other": {}})
    config.check_sections({"General": {}, "job.defaults": {}, "job.step.da": {}})
    assert config.lower_keys({"A": {"B": 1}}) == {"a": {"b": 1}}
    with pytest.raises(ValueError):
        config.lower_keys({"a": 1, "A": 2})
    assert config.dashed_flags("--foo_bar=a_b -x_y --baz_q") == "--foo-bar=a_b -x_y --baz-q"
    assert config.current_flags("-dal4 -x -deg") == "-B4 -x -D"
    assert R.read_config_text("[General]\nInputType = raw\n") == {"General": {"InputType": "raw"}}
    assert R.read_config_text('{"General": {"a": 1}}') == {"General": {"a": 1}}


def test_command_line(spark, tmp_path, capsys):
    from strandmill.plans import cli

    fasta = write(tmp_path / "a.fa", ">r1\nAAAA\n>r2\nAA\n")
    assert cli.main(["stats", fasta, "--bases", "4"]) == 0
    out = capsys.readouterr().out
    assert '"nreads": 2' in out and out.strip().endswith("4")
    ovl = write(tmp_path / "o.ovl", OVL)
    assert cli.main(["filter", ovl, str(tmp_path / "kept"), "--min-cov", "0", "--min-len", "1"]) == 0
    assert [x.split()[0] for x in lines(tmp_path / "kept")][:1] == ["000000001"] and lines(tmp_path / "kept")[1:] == ["---"]


def test_a_short_seed_stays_the_seed_and_long_reads_are_cut(spark):
    ddl = "stream string, pile long, ord long, read_id string, sequence string"
    rows = [("s", 0, 0, "seed", "ACGT"), ("s", 0, 1, "a", "A" * 8), ("s", 0, 2, "b", "C" * (consensus.MAX_READ + 5)), ("s", 0, 3, "a", "G" * 9)]
    few = consensus.ConsensusConfig(max_n_read=3, min_n_read=2, min_cov_aln=1)
    (found,) = consensus.piles(spark.createDataFrame(rows, ddl), few).collect()
    assert (found.seed_id, found.seed) == ("seed", "ACGT") and found.reads == ["C" * (consensus.MAX_READ - 1), "A" * 8]
    none = consensus.ConsensusConfig(max_n_read=1, min_n_read=2, min_cov_aln=1)
    assert consensus.piles(spark.createDataFrame(rows, ddl), none).count() == 0
