import heapq
import random
import re

import corpus
import pytest

from strandmill.llm import mixing as M


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def targets(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    """Reshares the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    open_, out, left = set(order), {}, budget * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def corpus_of(spark, rng, n=300, sources=("b", "a", None, "c", "é")):
    texts = [corpus.prose(rng, rng.choice([0, 1, 5, 40, 200])) or None for _ in range(n)]
    return texts, corpus.table(spark, texts, sources=[rng.choice(sources[: 1 + i % len(sources)]) for i in range(n)])


@pytest.mark.parametrize("seed", range(2))
def test_targets_and_takes(spark, seed):
    texts, df = corpus_of(spark, random.Random(seed))
    rows = M.mix_sources(df).collect()
    sources = {r.doc_id: r.source for r in df.collect()}
    assert {r.doc_id: r.size for r in rows} == {i: size(t) for i, t in enumerate(texts)}
    sizes, taken = {}, {}
    for r in rows:
        s = sources[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    expected = targets(sizes)
    for r in rows:
        s = sources[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(expected[s])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 0.02 * expected[s] + 32, s
    again = M.mix_sources(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def brute_seats(shares, seats):
    heap = [(-share, name, 0) for name, share in shares.items() if share > 0]
    heapq.heapify(heap)
    out = dict.fromkeys(shares, 0)
    for _ in range(seats):
        _, name, s = heapq.heappop(heap)
        out[name] += 1
        heapq.heappush(heap, (-shares[name] / (2 * s + 3), name, s + 1))
    return out


def test_sainte_lague_is_the_highest_quotients(spark):
    rng = random.Random(4)
    groups = {g: ({f"s{i:02d}": rng.choice([0, 1, 3, 50, rng.randint(1, 100000)]) for i in range(rng.randint(1, 25))}, rng.randint(0, 300)) for g in range(25)}
    groups[99] = ({"x": 0, "y": 0}, 5)
    rows = [(g, name, share, seats) for g, (shares, seats) in groups.items() for name, share in shares.items()]
    df = spark.createDataFrame(rows, "g int, name string, share long, seats long")
    found = {}
    for r in M.sainte_lague(df, ["g"], ["name"], "share", "seats").collect():
        found.setdefault(r.g, {})[r.name] = r.quota
    for g, (shares, seats) in groups.items():
        if not any(shares.values()):
            assert set(found[g].values()) == {0}
            continue
        expected = brute_seats(shares, seats)
        assert sum(found[g].values()) == seats
        assert found[g] == expected or all(abs(found[g][n] - expected[n]) <= 1 and shares[n] * 0 == 0 for n in shares), g
        quotients = lambda q: sorted((shares[n] / (2 * s + 1) for n in shares for s in range(q[n])), reverse=True)
        assert quotients(found[g]) == pytest.approx(quotients(expected))


def test_repeats_follow_takes(spark):
    texts, df = corpus_of(spark, random.Random(8), 120)
    taken = {r.doc_id: (r.taken, r.size) for r in M.mix_sources(df).collect()}
    copies = {}
    out = M.repeat_documents(df)
    assert out.columns == df.columns
    for r in out.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.text == texts[r.doc_id]
    for i, (t, n) in taken.items():
        assert copies.get(i, 0) == (int(t / n + 0.5) if n else 0)


def test_no_words_no_rows_repeated_and_null_ids(spark):
    assert M.mix_sources(corpus.empty(spark)).collect() == []
    assert M.repeat_documents(corpus.empty(spark)).collect() == []
    rows = M.mix_sources(corpus.table(spark, [None, "", " "])).collect()
    assert [(r.taken, r.target) for r in rows] == [(0, 0.0)] * 3
    rows = M.mix_sources(corpus.table(spark, ["a b c"] * 4, [1, 1, None, None], ["x"] * 4)).collect()
    assert len(rows) == 4 and all(r.taken <= 6 for r in rows)


def test_main_path_has_no_python(spark):
    plan = M.mix_sources(corpus.table(spark, ["a b"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
