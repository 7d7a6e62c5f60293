import hashlib
import random
from collections import Counter

import corpus
import numpy as np
import pytest

from strandmill.llm import merge_runs as R
from strandmill.llm import suffix_dedup as S


def brute(texts, length=200):
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        starts = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), starts, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def check(spark, texts, ids=None, **kw):
    ids = list(range(len(texts))) if ids is None else ids
    rows = S.remove_repeats(corpus.table(spark, texts, ids), **kw).collect()
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in rows)
    assert found == sorted((str(i), *x) for i, x in zip(ids, brute([(t or "").encode() for t in texts])))
    return rows


def passages(rng, n=70):
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    shared = [corpus.prose(rng, rng.randint(20, 150), words) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = [corpus.prose(rng, rng.randint(0, 60), words)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared).split()
            if rng.random() < 0.6:
                p[rng.randrange(len(p))] = rng.choice(words)
            parts += [" ".join(p[rng.randint(0, 8) :]), corpus.prose(rng, rng.randint(0, 30), words)]
        out.append(" ".join(parts))
    return out


def test_front_coding_and_merge():
    rng = random.Random(5)
    for _ in range(100):
        runs = [
            sorted((bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))), b"x" * rng.randint(0, 3), i) for i in range(rng.randint(0, 20)))
            for _ in range(rng.randint(1, 9))
        ]
        out = list(R.merge([R.read_run(R.front_code(r)) for r in runs]))
        assert [o[1] for o in out] == sorted(r[0] for x in runs for r in x)
        assert all(b[0] == R.common(a[1], b[1]) for a, b in zip(out, out[1:]))
        assert sorted((o[1], *o[2]) for o in out) == sorted(r for x in runs for r in x)
    assert list(R.merge([])) == []


def test_merge_compares_only_behind_known_prefixes(monkeypatch):
    compared = []
    real = R.common
    runs = [R.front_code(sorted((b"same long prefix " * 20 + b"%04d" % rng, b"") for rng in range(i, 400, 8))) for i in range(8)]
    monkeypatch.setattr(R, "common", lambda a, b, known=0: compared.append(real(a, b, known) - known) or known + compared[-1])
    assert len(list(R.merge([R.read_run(b) for b in runs]))) == 400
    assert sum(compared) < 400 * 40


def test_extents_against_all_pairs():
    rng = random.Random(6)
    for _ in range(60):
        length, rows = 12, []
        for i in range(rng.randint(1, 14)):
            lead, windows = rng.randint(0, 6), None
            windows = rng.randint(1, lead + 1)
            left = "".join(rng.choice("ab") for _ in range(lead))
            right = "kk" + "".join(rng.choice("ab") for _ in range(length - (lead - windows + 1) - 2))
            rows.append((right.encode(), left.encode(), 1, i, lead - windows + 1, rng.choice([1, 1, 1, 2])))
        group = list(R.merge([R.read_run(R.front_code(sorted(rows)))]))
        found = {c: {o for a, b in zip(x[::2], x[1::2]) for o in range(a, b + 1)} for _, c, x in S.extents(group, length)}
        for right, left, _, c, least, n in rows:
            expected = set()
            for o in range(least, len(left) + 1):
                window = lambda r, f, o=o: f[:o] + r[: length - o] if o <= len(f) and length - o <= len(r) else None
                mine = (left[:o], right[: length - o])
                if n > 1 or any((f[:o], r[: length - o]) == mine and o <= len(f) and length - o <= len(r) for r, f, _, d, *_ in rows if d != c):
                    expected.add(o)
            assert found.get(c, set()) == expected


@pytest.mark.parametrize("crowd", [S.CROWD, 2])
def test_against_brute_force(spark, crowd):
    texts = passages(random.Random(7))
    check(spark, texts + [texts[3], None, "", "x", "a" * 1000, "a" * 199, "b" * 200, "ab" * 300, "a" * 201], crowd=crowd)


def test_awkward_texts_ids_and_empty(spark):
    texts = corpus.awkward_texts()
    check(spark, texts)
    check(spark, texts[:20] + texts[:2], [1, None, *range(2, 20), 5, None])
    check(spark, ["q"])
    assert S.remove_repeats(corpus.empty(spark)).collect() == []


def test_spans_never_cross_documents(spark):
    rng = random.Random(9)
    half = "".join(rng.choice("abc") for _ in range(150))
    rows = check(spark, [half, half, half + half])
    assert [r.n_removed for r in sorted(rows, key=lambda r: r.doc_id)] == [0, 0, 0]


def test_long_texts_are_scanned_in_pieces(spark, monkeypatch):
    rng = random.Random(10)
    text = "".join(rng.choice("abcdefgh") for _ in range(9000))
    monkeypatch.setattr(S, "PIECE", 700)
    import pyarrow as pa

    pieces = list(S._scan(200, 48)(iter([pa.RecordBatch.from_pydict({"row": pa.array([0], pa.int64()), "text": pa.array([text])})])))
    monkeypatch.setattr(S, "PIECE", 1 << 22)
    (whole,) = S._scan(200, 48)(iter([pa.RecordBatch.from_pydict({"row": pa.array([0], pa.int64()), "text": pa.array([text])})]))
    covered = lambda batches: {(h, s + i) for b in batches for h, s, m in zip(*[b.column(k).to_pylist() for k in (1, 3, 4)]) for i in range(m & 255)}
    assert len(pieces) > 10 and covered(pieces) == covered([whole])
    assert len(covered([whole])) == 9000 - 199


def test_periodic_texts_are_few_rows(spark):
    import pyarrow as pa

    for period in ("a", "ab", "0123456789" * 3):
        text = period * (400_000 // len(period))
        batches = S._scan(200, 48)(iter([pa.RecordBatch.from_pydict({"row": pa.array([0], pa.int64()), "text": pa.array([text])})]))
        assert sum(b.num_rows for b in batches) <= 4 * len(period) + 8
    rng = random.Random(11)
    tail = "".join(rng.choice("abcdefgh") for _ in range(400))
    check(spark, ["ab" * 400 + tail, "x" + "ab" * 150 + tail[:150], "c" * 5000, "abc" * 90 + "d" + "abc" * 90, tail + "e" * 190, "e" * 190])
