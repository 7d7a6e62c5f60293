import hashlib
import re
from collections import Counter

import corpus
import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from strandmill.llm import mixing, quality  # noqa: E402
from test_quality import brute, share, top  # noqa: E402
from test_simhash import brute_classes, near_texts, slow_fingerprint  # noqa: E402


def line_share(text):
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip("\x20\x09\x0a\x0b\x0c\x0d"):
            dup += len(re.sub("[\x20\x09-\x0d]", "", line)) if line in seen else 0
            seen.add(line)
    return dup / max(1, brute(text)[1])


def kept_by_rules(text):
    windows = all(share(text, n) <= m for n, m in quality.MAX_WINDOW_SHARE.items())
    tops = all(top(text, n) <= m for n, m in quality.MAX_TOP_SHARE.items())
    return not brute(text)[-1] and windows and tops and line_share(text) <= quality.MAX_LINE_SHARE


def test_stages_against_brute_force(spark, tmp_path):
    import random

    texts = corpus.awkward_texts(3, 60) + near_texts(random.Random(1))
    df = corpus.table(spark, texts)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "mixing", "bpe_round_trip"]
    left = {i: t for i, t in enumerate(texts) if kept_by_rules(t)}
    outs = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        assert {tuple(r)[5:] for r in docs.collect()} == {("clash",) * len(corpus.CLASHES)}
        outs.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    assert outs[0] == sorted(left)
    first = {}
    for i, t in sorted(left.items()):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t), i)
    left = {i: left[i] for i in first.values()}
    assert outs[1] == sorted(left)
    fps = {i: slow_fingerprint(t) for i, t in left.items()}
    classes, low = brute_classes(fps.values()), {}
    for i, f in fps.items():
        low[classes[f]] = min(i, low.get(classes[f], i))
    left = {i: left[i] for i in low.values()}
    assert outs[2] == sorted(left)

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    mixed = mixing.mix_sources(spark.createDataFrame(docs.collect(), docs.schema)).collect()
    copies = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixed if r.size}
    expected = Counter()
    for i, n in copies.items():
        ids = library.encode(left[i], add_special_tokens=False).ids
        expected[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(left[i].encode()).hexdigest()] += n
    found = Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert found == +expected


def test_stages_take_an_empty_table(spark):
    docs = corpus.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_null_and_repeated_ids_go_by_row(spark, tmp_path):
    rng = __import__("random").Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(8)]
    rows = [(None, texts[0]), (1, texts[0]), (None, texts[1]), (5, texts[2]), (1, texts[3]), (5, texts[4]), (5, texts[2]), (7, texts[5] + " " * 3), (None, None), (7, "x " * 50_000)]
    docs = corpus.table(spark, [t for _, t in rows], [i for i, _ in rows], ["s"] * len(rows)).repartition(3)
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.STAGES[1][1](spark, docs, "").collect())
    expected = [(1, texts[0]), (None, texts[1]), (5, texts[2]), (1, texts[3]), (5, texts[4]), (7, texts[5] + " " * 3), (None, None), (7, "x " * 50_000)]
    assert kept == Counter(expected)
    for stage in (2, 3):
        out = corpus_pipeline.STAGES[stage][1](spark, docs, "")
        assert out.columns == docs.columns
    left = Counter((r.doc_id, r.text) for r in corpus_pipeline.STAGES[2][1](spark, docs, "").collect())
    fps = {t: slow_fingerprint(t) for _, t in rows}
    classes = brute_classes(fps.values())
    first = {}
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(classes[fps[t]], i)
    assert sum(left.values()) == len(first) and sorted(str(i) for i, _ in left) == sorted(str(i) for i in first.values())

    # Rows of one id are mixed on their own: each is there as often as its own words were taken.
    three = corpus.table(spark, ["a " * 40, "b " * 40, "c " * 40, "d"], [4, 4, None, 9], ["s", "t", "s", "u"])
    copies = Counter(r.text for r in mixing.repeat_documents(three).collect())
    taken = {r.size: r for r in mixing.mix_sources(three).collect()}
    assert set(copies) <= {"a " * 40, "b " * 40, "c " * 40, "d"} and max(copies.values()) <= 2 and len(taken) == 2
    sizes = Counter()
    for t, n in copies.items():
        sizes[{"a": "s", "b": "t", "c": "s", "d": "u"}[t[0]]] += n * len(t.split())
    targets = {r.source: r.target for r in mixing.mix_sources(three).collect()}
    assert all(abs(sizes[k] - v) <= 40 for k, v in targets.items())
