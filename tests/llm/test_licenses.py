import random

import corpus

from strandmill.llm import licenses as L


def brute(text):
    words, places, labels = L.words_of(text or ""), [], set()
    for phrase, label in L.BASE:
        p = phrase.split()
        for j in range(len(words) - len(p) + 1):
            if words[j : j + len(p)] == p:
                places.append(j)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def base_of(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_against_brute_force(spark):
    rng = random.Random(1)
    given = corpus.awkward_texts() + [corpus.prose(rng, 200) for _ in range(30)]
    given += ["MIT LICENSE", "mit\n\nLicense!mit-license", "mitlicense mit licens", "x general public license, Apache License", "mit general mit license general public"]
    found = {r.doc_id: r for r in L.scan_licenses(corpus.table(spark, given)).collect()}
    for i, text in enumerate(given):
        assert base_of(found[i]) == brute(text), text
        assert set(filter(None, found[i].base_labels.split(","))) <= set(filter(None, found[i].labels.split(",")))
        assert 0 <= found[i].score <= 1
    assert found[len(given) - 5].score > 0 and found[3].score == 0


NOISE = "Und der stone of zu Éreau "


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = max(before[j] + 1 if x == y else 0, before[j + 1], row[j])
    return row[-1]


def phrase_inside(words, phrase):
    """All words of the phrase in order, one other word between at most."""
    k = len(phrase)
    return any(words[i] == phrase[0] and common(phrase, words[i : i + k + 1]) == k for i in range(len(words)))


def best_places(text):
    """Brute force: each template's best score over all stretches of the text that hold its key phrases."""
    words, out = L.words_of(text), {}
    for t in L.TEMPLATES:
        mine = L.words_of(t.text)
        size = len(mine) + 2 * L.SLACK
        score = 0.0
        for i in range(0, max(len(words) - size, 0) + 1):
            here = words[i : i + size]
            if all(phrase_inside(here, L.words_of(p)) for p in t.key_phrases):
                score = max(score, common(mine, here) / len(mine))
        if score >= L.MIN_SCORE:
            out[t.label] = max(score, out.get(t.label, 0))
    return out


def test_whole_templates(spark):
    given = [NOISE * 3 + t.text + "\n" + NOISE for t in L.TEMPLATES] + [NOISE * 50, "permission to use the stone, without restriction", "x" * 100_000 + " " + L.TEMPLATES[0].text]
    found = {r.doc_id: r for r in L.scan_licenses(corpus.table(spark, given)).collect()}
    for i, t in enumerate(L.TEMPLATES):
        assert t.label in found[i].labels.split(",") and found[i].score == 1.0, t
    n = len(L.TEMPLATES)
    assert found[n].labels == found[n + 1].labels == "" and found[n + 2].labels == "mit"


def test_one_word_put_in_or_taken_out_anywhere(spark):
    given, labels = [], []
    for t in L.TEMPLATES:
        words = L.words_of(t.text)
        keys = [L.words_of(p) for p in t.key_phrases]
        inside = {j for k in keys for j in range(len(words)) for b in [next(i for i in range(len(words)) if words[i : i + len(k)] == k)] if b <= j < b + len(k)}
        for j in range(1, len(words)):
            given.append(NOISE + " ".join(words[:j] + ["stone"] + words[j:]) + " " + NOISE)
            labels.append(t.label)
            if j not in inside and len(words) > 5:
                given.append(NOISE + " ".join(words[:j] + words[j + 1 :]) + " " + NOISE)
                labels.append(t.label)
    found = {r.doc_id: r.labels.split(",") for r in L.scan_licenses(corpus.table(spark, given)).collect()}
    lost = [g for i, (g, label) in enumerate(zip(given, labels, strict=True)) if label not in found[i]]
    assert len(given) > 2000 and not lost, lost[:5]


def test_labels_against_brute_force(spark):
    rng = random.Random(2)
    given = []
    for t in L.TEMPLATES:
        words = L.words_of(t.text)
        for rate in (0.05, 0.2, 0.6):
            edited = [w for w in words for _ in range(1) if rng.random() > rate / 2]
            edited = [x for w in edited for x in ([w, rng.choice(["stone", "münch"])] if rng.random() < rate / 2 else [w])]
            given.append(NOISE * rng.randint(0, 3) + " ".join(edited) + " " + corpus.prose(rng, 12))
    given += [" ".join(rng.choice(L.words_of(t.text)) for _ in range(40)) for t in L.TEMPLATES]
    found = {r.doc_id: r for r in L.scan_licenses(corpus.table(spark, given)).collect()}
    agree = tried = 0
    for i, text in enumerate(given):
        truth = best_places(text) | {label: 1.0 for phrase, label in L.BASE if phrase_inside(L.words_of(text), phrase.split()) and label in found[i].base_labels}
        told = set(filter(None, found[i].labels.split(",")))
        assert told <= set(truth), (text, told, truth)
        tried += len(truth)
        agree += len(told & set(truth))
    print("labels", agree, "of", tried)
    assert agree >= 0.9 * tried  # what is lost are phrases met by chance among shuffled licence words


def test_key_phrases_are_mandatory():
    index = L.default_index()
    words = L.word_hashes(L.words_of("licensed under the apache software terms version 2 0"))
    t = next(i for i, x in enumerate(L.TEMPLATES) if x.text.startswith("Licensed under the Apache License"))
    assert index.score(words, t, 0) == 0.0


def test_empty_table_and_repeats(spark):
    assert L.scan_licenses(corpus.empty(spark)).collect() == []
    rows = L.scan_licenses(corpus.table(spark, ["mit license"] * 3, [1, 1, None])).collect()
    assert [r.n_base for r in rows] == [1, 1, 1]
