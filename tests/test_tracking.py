"""Read tracking against plain loops."""

import heapq
import random

from strandmill import schema
from strandmill.operators import tracking as T


def test_tracks_against_heaps(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(400):
        rows.append((f"{rng.randint(0, 30):09d}", f"{rng.randint(0, 12):09d}", -rng.randint(1, 40), 90.0, 0, 0, 9, 9, 0, 0, 9, rng.choice([10, 5000]), "overlap"))
    mapped = [(f"{rng.randint(0, 40):09d}", f"{rng.randint(0, 4):06d}F") for _ in range(60)]
    known = {}
    for r, c in mapped:
        known.setdefault(r, set()).add(c)
    heaps = {}
    for r in rows:
        if r[11] >= 100 and r[0] in known:
            h = heaps.setdefault(r[1], [])
            heapq.heappush(h, (-r[2], r[0]))
            if len(h) > 7:
                heapq.heappop(h)
    expected = []
    for read, h in heaps.items():
        votes = {}
        for n, q in h:
            for c in known[q]:
                v = votes.setdefault(c, [0, 0])
                v[0] -= n
                v[1] += 1
        for rank, (c, (score, n)) in enumerate(sorted(votes.items(), key=lambda x: (x[1][0], x[0]))):
            expected.append((read, c, n, rank, score, int(c in known.get(read, ()))))
    df, m = spark.createDataFrame(rows, schema.OVERLAPS), spark.createDataFrame(mapped, "rid string, ctg string")
    assert sorted(map(tuple, T.track_reads(df, m, 100, 7).collect())) == sorted(expected)


def test_id_chain_and_map(spark):
    preads = spark.createDataFrame([(0, "prolog/0000000031/0_500"), (1, "prolog/0000000007/0_600")], "ord long, name string")
    raws = spark.createDataFrame([(i, f"movie/{i}") for i in range(5)], "ord long, name string")
    chain = T.id_chain(preads, raws)
    assert sorted(map(tuple, chain.collect())) == [(0, 3, "movie/3"), (1, 0, "movie/0")]
    nodes = spark.createDataFrame([("000000F", "000000000:B"), ("000000F", "000000000:E"), ("000000R", "000000001:E"), ("000001F", "000000001:E")], "ctg_id string, node string")
    assert sorted(map(tuple, T.read_to_contig_map(nodes, chain).collect())) == [("000000000", "000000003", "movie/3", "000000F"), ("000000001", "000000000", "movie/0", "000001F")]


def test_assignments_and_partitions(spark):
    ddl = "bread string, ctg string, count long, rank int, score long, in_ctg int"
    raw = spark.createDataFrame([("000000000", "000000F-001-01", 1, 0, -5, 0), ("000000000", "000009F", 1, 1, -4, 0), ("000000002", "000002F", 1, 0, -5, 0)], ddl)
    pre = spark.createDataFrame([("000000007", "000001F", 1, 0, -5, 0)], ddl)
    names = spark.createDataFrame([(i, f"m/{i}") for i in range(4)], "ord long, name string")
    chain = spark.createDataFrame([(7, 2, "m/2")], "pid long, rid long, oid string")
    a = T.read_assignments(raw, pre, chain, names)
    assert sorted(map(tuple, a.collect())) == [("m/0", "000000F"), ("m/2", "000001F")]
    hits = T.contig_hits(raw, pre)
    assert sorted(map(tuple, hits.collect())) == [("000000F", 1), ("000001F", 1), ("000002F", 1)]
    contigs = spark.createDataFrame([("000000F", "A" * 30), ("000001F", "A" * 3), ("000003", "A" * 30)], "id string, sequence string")
    reads = spark.createDataFrame([("m/0", "AC"), ("m/2", "GG"), ("m/9", "T")], "id string, sequence string")
    assert sorted((r.id, r.ctg) for r in T.partition_reads(reads, a, contigs, 10).collect()) == [("m/0", "000000F"), ("m/2", "unassigned"), ("m/9", "unassigned")]
    many = spark.createDataFrame([("000000F", 5), ("000003", 9)], "ctg string, hits long")
    assert [r[0] for r in T.listed_contigs(contigs, many, 10).collect()] == ["000000F"]
    assert T.listed_contigs(contigs, hits, 10).collect() == []
