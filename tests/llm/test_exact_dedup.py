import hashlib
import random
import re
from collections import Counter

import corpus
import pyarrow as pa

from strandmill.llm import exact_dedup as E


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(ids, texts):
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in zip(ids, texts):
        g = groups[norm(t)]
        out.append((i, min(g), len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out)


def check(spark, texts, ids=None, **kw):
    ids = list(range(len(texts))) if ids is None else ids
    rows = E.exact_dedup(corpus.table(spark, texts, ids), **kw).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == brute(ids, texts)
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) <= {1} and len(kept) == len({norm(t) for t in texts})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_against_brute_force(spark):
    texts = corpus.awkward_texts()
    check(spark, texts + ["a  b", "a\tb", "a b ", None, "\n", " "])


def test_hot_groups_and_few_counters(spark):
    rng = random.Random(2)
    texts = ["hot one"] * 150 + ["hot  two"] * 60 + [f"t{rng.randint(0, 90)}" for _ in range(200)]
    rng.shuffle(texts)
    check(spark, texts, counters=4)
    check(spark, texts, [10_000 - i for i in range(len(texts))], counters=1)


def test_repeated_ids_keep_one_row(spark):
    check(spark, ["x", "x", "y", "x"], [5, 5, 5, 9])
    rows = E.exact_dedup(corpus.table(spark, ["x", "x", None], [None, 3, None])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in rows} == {(None, 3, False), (3, 3, True), (None, None, True)}


def test_misra_gries_never_loses_a_frequent_digest():
    rng = random.Random(3)
    for _ in range(50):
        values = [bytes([min(int(rng.expovariate(0.3)), 60)]) for _ in range(rng.randint(1, 400))]
        k = rng.randint(1, 12)
        batches = [pa.RecordBatch.from_pydict({"digest": pa.array(values[i : i + 37], pa.binary())}) for i in range(0, len(values), 37)]
        (out,) = E.misra_gries(k)(iter(batches))
        kept = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
        assert len(kept) <= k
        for value, n in Counter(values).items():
            assert n - len(values) / (k + 1) <= kept.get(value, 0) <= n


def test_stage(spark):
    texts = corpus.awkward_texts()
    df = corpus.table(spark, texts + ["x", "x", "x"], [*range(len(texts)), 900, 900, 901])
    out = E.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(norm(r.text) for r in out.collect()) == sorted({norm(t) for t in texts + ["x"]})
    assert E.drop_copies(corpus.empty(spark)).collect() == E.exact_dedup(corpus.empty(spark)).collect() == []
