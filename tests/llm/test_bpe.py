import hashlib
import json
import random

import corpus
import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from strandmill.llm import bpe, token_counts  # noqa: E402

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(json.load(f))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def samples():
    rng = random.Random(1)
    alphabets = ["abcdefghij klmnop'st", "éèàüßñç ẞ中文字😀‍ ", "  \n\t\r\x0b\x00\x1c\x85 　", "0123 456٣٤५½²", "aaaaaaaaaaaa", "!!!???---===...   ", "ethn the ing tion", "ա֋಼Ა"]
    out = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    out += ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    out += [c * n for c in "aeot-= .\n" for n in (1, 2, 3, 7, 16, 33, 64, 65, 127, 255, 300)]
    return out + [f"{a}<|endoftext|>{b}" for a, b in (("x ", " y"), ("", ""), ("  ", "\n"), ("<|endoftext|>", "<|endof"))]


def test_encoder_is_the_librarys(vocabulary, library):
    for text in samples() + [t or "" for t in corpus.awkward_texts()]:
        assert vocabulary.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_decoder_is_the_librarys(vocabulary, library):
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(50257), 50256, rng.randrange(256)]) for _ in range(rng.randint(0, 30))]
        text = vocabulary.decode(np.array(ids, "<u4")).decode("utf-8", "replace")
        assert text == library.decode(ids, skip_special_tokens=False)


def test_pairs_agree_with_their_own_encoding(vocabulary, library):
    rng = random.Random(3)
    for _ in range(3000):
        a, b = rng.randrange(50256), rng.randrange(50256)
        raw = vocabulary.token[a] + vocabulary.token[b]
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if vocabulary.split(text) == [text]:
            assert vocabulary.compatible(a, b) == (vocabulary.encode(text) == [a, b]), (a, b)


def test_round_trip_and_parts(spark, library):
    texts = corpus.awkward_texts() + ["x <|endoftext|> y", "repeated", "repeated"]
    ids = [*range(len(texts) - 2), 7, None]
    df = corpus.table(spark, texts, ids)
    expected = []
    for i, t in zip(ids, texts):
        e = library.encode(t or "", add_special_tokens=False).ids
        expected.append((str(i), len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), *r[1:]) for r in bpe.round_trip(df, PATH).collect()) == sorted(expected)
    encoded = bpe.encode(df, PATH)
    assert sorted(hashlib.sha256(r.ids).hexdigest() for r in encoded.collect()) == sorted(e[2] for e in expected)
    assert sorted(r.text for r in bpe.decode(encoded, PATH).collect()) == sorted(t or "" for t in texts)


def test_counts(spark, library):
    texts = corpus.awkward_texts() + ["x <|endoftext|> y"] * 2
    df = corpus.table(spark, texts)
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    rows = sorted(tuple(r) for r in token_counts.count_tokens(df, PATH, limit=100).collect())
    assert rows == [(*e, e[2] > 100) for e in expected]


def test_caches_are_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    monkeypatch.setattr(token_counts, "CACHE", 20)
    packed, lengths = bpe.Packed(vocabulary), token_counts.Lengths(vocabulary, {" the": 1})
    for i in range(500):
        assert np.frombuffer(packed[f"w{i}"], "<u4").tolist() == vocabulary.encode_piece(f"w{i}")
        assert lengths[f"w{i}"] == len(vocabulary.encode_piece(f"w{i}"))
    assert len(packed) <= 22 and len(lengths) <= 23
    packed["x" * 100]
    assert "x" * 100 not in packed


def test_frequent_table_packs(vocabulary):
    table = {" the": 1, "é中": 4, "": 0, "a": 1}
    assert token_counts.unpack(token_counts.pack(table)) == table


def test_table_of_counts_reads_no_text(spark, vocabulary, library, monkeypatch):
    df, sc = corpus.table(spark, corpus.awkward_texts()), spark.sparkContext
    sc.setJobGroup("op5-table", "")
    counted = token_counts.count_tokens(df, PATH)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(sc.statusTracker().getJobIdsForGroup("op5-table")) == []
    found = token_counts.frequent_pieces(vocabulary)
    assert len(found) > 40_000 and all(len(library.encode(p, add_special_tokens=False).ids) == len(vocabulary.encode_piece(p)) for p in found[::100])
    assert token_counts.frequent_pieces(vocabulary, 10) == found[:10]
    rows = sorted(map(tuple, counted.collect()))
    monkeypatch.setattr(token_counts, "frequent_pieces", lambda v: [])
    assert sorted(map(tuple, token_counts.count_tokens(df, PATH).collect())) == rows


def test_empty_tables(spark):
    assert bpe.round_trip(corpus.empty(spark), PATH).collect() == []
    assert token_counts.count_tokens(corpus.empty(spark), PATH).collect() == []
