"""Overlap filtering on the twelve-row fixture and against plain loops."""

import random

import pytest

from strandmill import schema
from strandmill.operators import overlaps as O

ROWS = """000000000 000000001 -1807 100.00 0 181 1988 1988 0 0 1807 1989 overlap
000000000 000000002 -823 99.88 0 0 823 1988 0 1166 1989 1989 overlap
000000000 000000003 -50 99.94 0 0 50 1988 0 0 50 50 overlap
000000000 000000017 -61 98.36 0 1927 1988 1988 0 0 61 1988 overlap
000000000 000000028 -1952 79.95 0 0 1952 1988 0 37 1989 1989 overlap
000000001 000000000 -1807 100.00 0 0 1807 1989 0 181 1988 1988 overlap
000000001 000000002 -642 99.84 0 0 642 1989 0 1347 1989 1989 overlap
000000002 000000000 -823 99.88 0 1166 1989 1989 0 0 823 1988 overlap
000000003 000000000 -50 99.94 0 0 50 50 0 0 50 1988 overlap
000000017 000000000 -61 98.36 0 0 61 1988 0 1927 1988 1988 overlap
000000017 000000002 -100 98.00 0 0 100 1988 0 0 100 1989 overlap
000000028 000000000 -1952 79.95 0 37 1989 1989 0 0 1952 1988 overlap"""


def table(spark, text):
    kinds = {"string": str, "int": int, "double": float}
    rows = [tuple(kinds[t](x) for x, t in zip(line.split(), schema.types(schema.OVERLAPS), strict=True)) for line in text.splitlines()]
    return spark.createDataFrame(rows, schema.OVERLAPS)


def loop_counts(rows, min_len):
    out = {}
    for r in rows:
        c = out.setdefault(r["q_id"], [0, 0])
        if r["identity"] >= 90 and r["q_l"] >= min_len and r["t_l"] >= min_len:
            c[0] += r["q_s"] == 0
            c[1] += r["q_e"] == r["q_l"]
    return out


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_read_whose_rows_are_all_rejected_is_ignored(spark):
    rows = table(spark, ROWS)
    found = ids(O.ignored_reads(rows))
    expected = sorted(q for q, (a, b) in loop_counts(rows.collect(), 1).items() if min(a, b) < 1)
    assert found == expected
    assert "000000028" in found


def test_single_rows_and_empty_input(spark):
    lines = ROWS.splitlines()
    assert ids(O.ignored_reads(table(spark, lines[8]))) == []
    assert ids(O.ignored_reads(table(spark, lines[9]))) == ["000000017"]
    assert ids(O.ignored_reads(table(spark, ""))) == []


def test_overlap_stats(spark):
    rows = table(spark, ROWS)
    found = sorted(tuple(r) for r in O.overlap_stats(rows, 62).collect())
    lengths = {r["q_id"]: r["q_l"] for r in rows.collect()}
    assert found == sorted((q, lengths[q], a, b) for q, (a, b) in loop_counts(rows.collect(), 62).items() if a or b)


def random_rows(rng, n):
    out = []
    for _ in range(n):
        q, t = rng.randint(0, 6), rng.randint(0, 6)
        length, q_l, t_l = rng.randint(1, 30), 40, 2000 + rng.randint(0, 3) * 600
        q_s = rng.choice([0, 0, 40 - length, 3])
        out.append(
            (f"{q:09d}", f"{t:09d}", -length, rng.choice([80.0, 95.0, 99.0]), 0, q_s, q_s + length, q_l, 0, 0, rng.choice([100, 1900]), t_l, rng.choice(["overlap"] * 8 + ["contains", "contained"]))
        )
    return sorted(out)


def loop_best(rows, ignored, contained, bestn):
    groups = {}
    for r in rows:
        if r[0] in contained | ignored or r[1] in contained | ignored or r[3] < 90:
            continue
        end = 0 if r[5] == 0 else 1 if r[6] == r[7] else None
        if end is not None:
            groups.setdefault((r[0], end), []).append((r[2], r[11] - (r[10] - r[9]), [str(x) for x in r], r))
    out = []
    for group in groups.values():
        for i, (_, m_range, _, r) in enumerate(sorted(group)):
            out.append(r)
            if i >= bestn and m_range > 1000:
                break
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_best_overlaps_against_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 150)
    df = spark.createDataFrame(rows, schema.OVERLAPS)
    limits = O.CoverageLimits(max_diff=6, max_cov=14, min_cov=1, min_len=1)
    ignored = {r[0] for r in O.ignored_reads(df, limits).collect()}
    contained = {r[0] for r in O.contained_reads(df, O.ignored_reads(df, limits), limits).collect()}
    good = [r for r in rows if r[3] >= 90 and not {r[0], r[1]} & ignored]
    assert contained == {r[0] for r in good if r[12] == "contained"} | {r[1] for r in good if r[12] == "contains"}
    found = sorted(tuple(r) for r in O.filter_overlaps(df, 2, limits).collect())
    assert found == loop_best(rows, ignored, contained, 2)


def test_containment_for_the_graph_ignores_thresholds(spark):
    rows = table(
        spark,
        """000000001 000000002 -100 50.00 0 0 100 10 0 0 100 10 contains
000000001 000000003 -100 99.00 0 0 100 5000 0 0 100 5000 overlap
000000003 000000002 -100 99.00 0 0 100 5000 0 0 100 5000 overlap
000000003 000000004 -100 99.00 0 0 100 5000 0 0 100 5000 none
000000003 000000003 -100 99.00 0 0 100 5000 0 0 100 5000 contained""",
    )
    assert [(r.q_id, r.t_id) for r in O.graph_rows(rows).collect()] == [("000000001", "000000003")]


def test_first_per_pair(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", "b", 2), ("b", "a", 1), ("a", "c", 3)], "q string, t string, ord int")
    assert sorted(tuple(r) for r in O.first_per_pair(df, "q", "t", [F.col("ord")]).collect()) == [("a", "c", 3), ("b", "a", 1)]
