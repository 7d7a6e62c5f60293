"""Statistics, tiling paths, sequence expressions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandmill import schema
from strandmill.functions import sequences as S
from strandmill.operators import paths as P
from strandmill.operators import stats
from strandmill.plans import catalogue


def histogram(spark, lengths):
    return stats.length_histogram(spark.createDataFrame([(x,) for x in lengths], "n int"), F.col("n"))


def test_cutoff(spark):
    h = spark.createDataFrame([(3, 1), (2, 2), (1, 1)], "rl long, count long")
    for target, cutoff in ((8, 1), (7, 2), (4, 2), (3, 3), (1, 3), (0, 3)):
        assert stats.coverage_cutoff(h, target).first()[0] == cutoff
    with pytest.raises(Exception, match="Not enough reads"):
        stats.coverage_cutoff(h, 9).collect()


def test_read_stats(spark):
    assert tuple(stats.read_stats(histogram(spark, [1, 2, 3, 4])).first()) == (4, 10, 3, 4, 3.0)
    rng = random.Random(1)
    lens = sorted(rng.randint(1, 40) for _ in range(57))
    total, upto = sum(lens), 0
    for n50 in reversed(lens):
        upto += n50
        if upto >= int(total * 0.5):
            break
    assert tuple(stats.read_stats(histogram(spark, lens)).first()) == (57, total, n50, lens[int(57 * 0.95)], sum(x * x for x in lens) / total)


def test_report_has_26_metrics(spark):
    h = histogram(spark, [1, 2, 3, 4])
    row = stats.assembly_report(h, h, h, None, None, 2.5, 75.0).first().asDict()
    assert len(row) == 26
    assert row["genome_length"] == -1 and row["raw_coverage"] == -10.0 and row["preassembled_yield"] == 1.0
    assert '"raw_n50": 3' in stats.report_json(stats.assembly_report(h, h, h, 5, 2))


def test_fragmentation_and_truncation(spark):
    pieces = spark.createDataFrame([(1,)] * 2 + [(2,)] * 3, "seed int")
    assert stats.fragmentation(pieces, "seed").first()[0] == 2.5
    a = spark.createDataFrame([(1, 50), (2, 60)], "k int, n int")
    b = spark.createDataFrame([(1, 55), (2, 65), (3, 70)], "k int, n int")
    assert stats.average_difference(a, b, "k", "n").first()[0] == -5.0
    assert stats.truncation(a, b, "k", "n").first()[0] == 5.0
    with pytest.raises(Exception, match="no value for key"):
        stats.average_difference(b, a, "k", "n").collect()


TILING = """000000F a:B b:B b 33726 0 16258 99.45
000000F b:B c:B c 10123 0 25619 99.85
000000F c:B d:E d 1352 0 24447 99.96
000000F d:E e:B e 0 2000 24447 99.96
000002F x:B y:B y 5238 0 1 99.0
000002F y:B z:B z 0 3235 1 99.0"""


def tiling(spark, text=TILING):
    rows, at = [], {}
    for line in text.splitlines():
        c = line.split()
        at[c[0]] = at.get(c[0], 0) + 1
        rows.append((c[0], c[1], c[2], c[3], int(c[4]), int(c[5]), int(c[6]), float(c[7]), at[c[0]]))
    return spark.createDataFrame(rows, schema.TILING + ", ord int")


def test_coordinates(spark):
    found = {(r.ctg_id, r.node): r.coord for r in P.node_coordinates(P.path_coordinates(tiling(spark))).collect()}
    assert [found["000000F", f"{n}"] for n in ("a:B", "b:B", "c:B", "d:E", "e:B")] == [0, 33726, 43849, 45201, 47201]
    assert [found["000002F", f"{n}"] for n in ("x:B", "y:B", "z:B")] == [0, 5238, 8473]


def test_coordinates_shift_by_the_first_node(spark):
    lengths = spark.createDataFrame([("000000F", 50000)], "ctg_id string, length long")
    rows = P.path_coordinates(tiling(spark), contig_lengths=lengths).filter("ctg_id = '000000F'").orderBy("ord").collect()
    assert rows[0].v_coord == 50000 - 47201 and rows[-1].w_coord == rows[-1].contig_len == 50000
    short = spark.createDataFrame([("000000F", 5)], "ctg_id string, length long")
    with pytest.raises(Exception, match="shorter"):
        P.path_coordinates(tiling(spark), contig_lengths=short).collect()


def test_continuity(spark):
    P.check_continuity(tiling(spark)).collect()
    broken = TILING.replace("c:B d:E", "q:B d:E")
    with pytest.raises(Exception, match="sorted order"):
        P.check_continuity(tiling(spark, broken)).collect()


def test_a_node_visited_again_keeps_its_last_coordinate(spark):
    loop = "1F a:B b:B b 10 0 1 99\n1F b:B a:B a 5 0 1 99"
    found = {r.node: r.coord for r in P.node_coordinates(P.path_coordinates(tiling(spark, loop))).collect()}
    assert found == {"a:B": 15, "b:B": 10}


def test_placement(spark):
    located = P.path_coordinates(tiling(spark))
    a = tiling(spark, "000000F-001-01 b:B k:B k 9 0 1 99\n000000F-001-01 k:B d:E d 9 0 1 99")
    assert tuple(P.place_alternatives(located, a).select("a_ctg_id", "p_ctg_id", "start", "end").first()) == ("000000F-001-01", "000000F", 33726, 45201)
    lost = tiling(spark, "000009F-001 b:B k:B k 9 0 1 99")
    with pytest.raises(Exception, match="no place"):
        P.place_alternatives(located, lost).collect()


def loop_sub_path(coords, start, end):
    first = 0 if start < coords[0] else None
    last = 1 if end <= coords[0] else None
    for i in range(len(coords) - 1):
        if coords[i] <= start < coords[i + 1]:
            first = i
        if coords[i] < end <= coords[i + 1]:
            last = i + 1
    if end >= coords[-1]:
        last = len(coords) - 1
    return None if first is None else (first, last, start - coords[first], end - coords[first])


def test_sub_paths(spark):
    located = P.path_coordinates(tiling(spark)).filter("ctg_id = '000000F'")
    coords = [0, 33726, 43849, 45201, 47201]
    ranges = [(0, 47201), (-100, 47201), (-100, 50000), (43859, 46000), (33726, 45201), (33726, 45202), (-100, -10), (0, 0), (47200, 47201), (46000, 99999)]
    asked = spark.createDataFrame([("000000F", *r) for r in ranges], "ctg_id string, start long, end long")
    found = {}
    for r in P.sub_paths(located, asked).orderBy("ord").collect():
        found.setdefault((r.start, r.end), []).append((r.ord, r.new_start, r.new_end))
    for r in ranges:
        first, last, a, b = loop_sub_path(coords, *r)
        assert found[r] == [(i + 1, a, b) for i in range(first, last)], r
    bad = spark.createDataFrame([("000000F", 10, 7)], "ctg_id string, start long, end long")
    with pytest.raises(Exception, match="end before start"):
        P.sub_paths(located, bad).collect()


def one(spark, column, **values):
    names = list(values)
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'int' if isinstance(values[n], int) else 'string'}" for n in names))
    return row.select(column.alias("x")).first()[0]


def test_reverse_complement(spark):
    assert one(spark, S.reverse_complement(F.col("s")), s="AACGTNacg-") == "-cgtNACGTT"
    with pytest.raises(Exception, match="no complement"):
        one(spark, S.reverse_complement(F.col("s")), s="AXC")
    assert one(spark, S.complement(F.col("s")), s="ACGT") == "TGCA"


def test_reverse_end(spark):
    assert one(spark, S.reverse_end(F.col("s")), s="123:B") == "123:E"
    assert one(spark, S.reverse_end(F.col("s")), s="123:E") == "123:B"
    assert one(spark, S.reverse_end(F.col("s")), s="NA") == "NA"
    for bad in (":", "", "12345:C", ":::"):
        with pytest.raises(Exception, match="not a node"):
            one(spark, S.reverse_end(F.col("s")), s=bad)


def test_slices_and_kmers(spark):
    assert one(spark, S.slice_sequence(F.col("s"), F.col("a"), F.col("b")), s="AACGTT", a=1, b=3) == "AC"
    assert one(spark, S.slice_sequence(F.col("s"), F.col("a"), F.col("b")), s="AACGTT", a=3, b=1) == "GT"
    assert [tuple(x) for x in one(spark, S.kmers(F.col("s"), 3), s="ACGTNAAAA")] == [(0, "ACG"), (1, "CGT"), (5, "AAA")]
    assert one(spark, S.kmers(F.col("s"), 3), s="AC") == []
    assert one(spark, S.kmer_code(F.col("s")), s="CGT") == 1 * 16 + 2 * 4 + 3


def test_text_helpers(spark):
    assert one(spark, S.clean_regions(F.col("s")), s="acgTTaGGGn") == ["TT", "GGG"]
    assert one(spark, S.wrap(F.col("s"), 4), s="AACCGGTT") == "AACC\nGGTT"
    assert one(spark, S.header_id(F.col("s")), s="a/1 x y") == "a/1"
    assert one(spark, S.header_metadata(F.col("s")), s="a/1 x y") == "x y"
    assert one(spark, S.header_metadata(F.col("s")), s="a/1") is None
    assert one(spark, S.parent_contig(F.col("s")), s="000000F-001-01") == "000000F"
    assert one(spark, S.parent_contig(F.col("s")), s="000000F_1") == "000000F"
    assert one(spark, S.int_with_commas(F.col("s")), s="1,234,567") == 1234567
    assert one(spark, S.encode_edges(S.decode_edges(F.col("s"))), s="a~b~c|d~NA~f") == "a~b~c|d~NA~f"
    assert one(spark, S.encode_path(S.reverse_path(S.decode_path(F.col("s")))), s="1:B~2:E") == "2:B~1:E"
    assert one(spark, S.alternative_name(F.col("s"), F.lit(1), F.lit(2)), s="000000F") == "000000F-001-02"
    assert one(spark, S.read_name(F.col("n")), n=7) == "000000007"


def test_statistics_of_very_many_bases(spark):
    rows = spark.createDataFrame([(100_000, 10**12), (50_000, 10**12)], "rl long, count long")
    found = stats.read_stats(rows).first()
    assert (found.total, found.n50) == (15 * 10**16, 100_000) and found.esize == pytest.approx(12_500 / 15 * 100)


def test_notations_agree_with_their_sql_beyond_the_width_of_names(spark, tmp_path):
    keys = [0, 7, 999_999, 1_000_000, 1_199_999, 999_999_999, 1_234_567_890]
    import duckdb

    rows = [(k, "blue anvil", n) for k in keys for n in (1, 50, 999, 1000)] + [(None, "x", 1), (5, None, None), (6, "one", 3)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = [tuple(r) for r in catalogue.queries()["q_notations"](spark, str(tmp_path)).collect()]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert Counter(found) == Counter(db.execute(catalogue.oracle_sql()["q_notations"]).fetchall())
    assert one(spark, S.contig_name(F.col("n")), n=1_199_999) == "1199999F"
