import re
from collections import Counter

import corpus
import pytest

from strandmill.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j + k for j in range(len(words) - 4) if count[tuple(words[j : j + 5])] > 1 for k in range(5)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def share(text, n):
    words = WORD.findall(text or "")
    count = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    covered = {j + k for j in range(len(words) - n + 1) if count[tuple(words[j : j + n])] > 1 for k in range(n)}
    return sum(len(words[i]) for i in covered) / max(1, sum(map(len, words)))


def top(text, n):
    words = WORD.findall(text or "")
    count = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    often = [(k, sum(map(len, w))) for w, k in count.items() if k >= Q.LEAST_TOPS]
    k, size = max(often, default=(0, 0))
    return k * size / max(1, sum(map(len, words)))


def thue_morse(n, a, b):
    tail = [0]
    while len(tail) < n:
        tail += [1 - x for x in tail]
    return "".join((a, b)[x] for x in tail[:n])


def texts():
    out = corpus.awkward_texts()
    base = " ".join(f"w{i}" for i in range(40))
    return out + [base + " " + base, base + " w1 w2 w3 w4 w5 w6", (base + "\n") * 5, "# * $ %% a b c d e f g h i j", "A\r\nA\r\nb c d e f g h i"] + [
        "say it loud " * 3 + base, " ".join(f"a{i} of the b{i}" for i in range(9)), "\n".join(thue_morse(2048, *p) for p in ("ab", "ba")) + "\n" + base,
        " ".join(thue_morse(2048, *p) for p in ("ab", "ba", "ab", "ba")),
        " ".join(f"w{i}" for i in range(43)) + " " + " ".join(f"w{i}" for i in range(5, 10)),
    ]


def test_against_brute_force(spark):
    given = texts()
    found = {r.doc_id: r for r in Q.quality(corpus.table(spark, given)).collect()}
    assert len(found) == len(given)
    for i, text in enumerate(given):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), text
        assert r.window_share == pytest.approx(max(share(text, n) for n in Q.MAX_WINDOW_SHARE)), text
        assert r.top_share == pytest.approx(max(top(text, n) for n in Q.MAX_TOP_SHARE)), text
        verdict = r.base_failed or any(share(text, n) > m for n, m in Q.MAX_WINDOW_SHARE.items()) or r.line_share > Q.MAX_LINE_SHARE
        verdict = verdict or any(top(text, n) > m for n, m in Q.MAX_TOP_SHARE.items())
        assert r.kept == (not verdict)


def test_repeated_lines_are_rejected_though_windows_are_few(spark):
    text = "\n".join(["aa bb cc"] * 3 + [" ".join(f"w{i}" for i in range(12))])
    r = Q.quality(corpus.table(spark, [text])).first()
    assert not r.base_failed or r.n_repeat_words
    assert r.line_share == pytest.approx(12 / (18 + sum(len(f"w{i}") for i in range(12))))


def test_the_method_rejects_what_the_base_rule_keeps(spark):
    words = [f"word{i}" for i in range(100)]
    windows = " ".join(words[:9] + ["longlonglonglong"] + words[10:90] + words[:9] + ["longlonglonglong"])  # ten of a hundred words, twice
    tops = " ".join(x for i in range(9) for x in ("thequick", "brownfox", f"a{i}", f"b{i}"))
    a, b, c = sorted(Q.quality(corpus.table(spark, [windows, tops, " ".join(words)])).collect(), key=lambda r: r.doc_id)
    assert (a.base_failed, a.kept, b.base_failed, b.kept, c.kept) == (False, False, False, False, True)


def test_different_lines_that_hash_alike_modulo_a_power_of_two(spark):
    lines = [thue_morse(2048, *p) for p in ("ab", "ba")]
    r = Q.quality(corpus.table(spark, ["\n".join(lines)])).first()
    assert r.n_dup_lines == 0 and r.line_share == 0


def test_small_chunks_give_the_same(spark, monkeypatch):
    import numpy as np

    from strandmill.llm import textspans as T
    import pyarrow as pa

    column = T.texts_of(pa.array(texts()))
    whole = [Q._measure(d, o) for *_, d, o in T.chunks(column, 1 << 30)]
    small = [Q._measure(d, o) for *_, d, o in T.chunks(column, 64)]
    assert len(whole) == 1 and len(small) > 10
    for key in whole[0]:
        assert np.allclose(whole[0][key], np.concatenate([m[key] for m in small]))


def test_stage_keeps_columns_and_rows(spark):
    df = corpus.table(spark, texts())
    kept = Q.drop_low_quality(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in Q.quality(df).collect() if r.kept)


def test_empty_table(spark):
    assert Q.quality(corpus.empty(spark)).collect() == []
    assert Q.drop_low_quality(corpus.empty(spark)).collect() == []
