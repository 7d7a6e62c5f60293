import random
import re

import corpus
import numpy as np
import pytest
import xxhash

from strandmill.llm import simhash as S


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_classes(fps):
    fps = sorted(set(fps))
    a, up = np.array(fps, np.uint64), list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= 3):
            x, y = root(i), root(i + 1 + int(j))
            if x != y:
                up[max(x, y)] = min(x, y)
    return {f: fps[root(i)] for i, f in enumerate(fps)}


def test_fingerprints():
    for text in corpus.awkward_texts() + ["A B C", "a b c", "ÀB c D", "x y", "x"]:
        assert S.fingerprint((text or "").encode()) == slow_fingerprint(text), text


def clusters(rng, n=6, size=14):
    out = []
    for c in range(n):
        base = rng.getrandbits(64)
        low, high = rng.choice([(0, 64), (0, 21), (21, 42), (42, 64), (15, 30)])
        pool = rng.sample(range(low, high), min(high - low, rng.choice([4, 8, 15])))
        for _ in range(size):
            x = base
            for b in rng.sample(pool, rng.randint(0, 4)):
                x ^= 1 << b
            out.append(x)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_members_link_like_all_pairs(seed):
    fps = sorted(set(clusters(random.Random(seed))))
    keys = {}
    for fp in fps:
        for j in range(3):
            base = fp & (S._ALL ^ S._block_mask(j))
            for flip in [0, *[1 << b for b in range(64) if not S._block_mask(j) >> b & 1]]:
                keys.setdefault((j, base ^ flip), []).append(fp)
    sets = S._Sets()
    for (j, key), members in keys.items():
        for a, b in S.link_members(j, key, members) if len(members) > 1 else ():
            sets.join(a, b)
    assert {fp: sets.find(fp) for fp in fps} == brute_classes(fps)


def test_links_in_spark(spark):
    rng = random.Random(77)
    fps = set(clusters(rng, 12, 30)) | {rng.getrandbits(64) for _ in range(300)} | {0, 7, (1 << 64) - 1}
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    sets = S._Sets()
    for r in S.close_links(df).collect():
        sets.join(r.a & S._ALL, r.b & S._ALL)
    assert {f: sets.find(f) for f in fps} == brute_classes(fps)


def near_texts(rng):
    base = [f"w{rng.randint(0, 999)}" for _ in range(400)]
    out = []
    for _ in range(25):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 9)}"
        out.append(" ".join(words))
    return out


def test_documents_against_brute_force(spark):
    texts = corpus.awkward_texts() + near_texts(random.Random(5)) + ["", None, "One", "one"]
    ids = [1000 - 3 * i for i in range(len(texts))]
    fps = {i: slow_fingerprint(t) for i, t in zip(ids, texts)}
    classes, low = brute_classes(fps.values()), {}
    for i, f in fps.items():
        low[classes[f]] = min(i, low.get(classes[f], i))
    df = corpus.table(spark, texts, ids)
    rows = S.near_dedup(df).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{f:016x}", low[classes[f]]) for i, f in fps.items()}
    kept = S.drop_near_copies(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(low.values())


def test_empty_null_and_repeated(spark):
    assert S.near_dedup(corpus.empty(spark)).collect() == []
    rows = S.near_dedup(corpus.table(spark, ["a b c"] * 3 + ["zz"], [None, 4, 4, None])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
