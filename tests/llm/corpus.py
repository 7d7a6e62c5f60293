"""Small documents with every awkward case, and extra columns whose names clash with internal ones."""

import random

CLASHES = ("digest", "row", "size", "keep", "me", "fp", "target", "taken", "n", "key", "h", "words", "k_id", "m_id", "k_sha", "label", "node", "value")
CLASHES += ("__exact_sha", "__mix_copy", "__near_id", "__rules_text", "row_key", "Row_Key_", "copies", "copy", "no_id", "c_class", "class", "digest_")
WORDS = ["the", "of", "Éreau", "stone", "münch", "ñu", "license", "mit", "apache", "general", "public", "ok", "x1", "a", "zu"]


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


def awkward_texts(seed=0, n=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    passage = prose(rng, 60, vocabulary)
    texts = [prose(rng, rng.randint(1, 120), vocabulary) for _ in range(n)]
    texts += [texts[0], texts[1].replace(" ", "  \n"), texts[2] + " tail", None, "", " \t\n", "one", "one two", "a" * 700, "ab" * 300]
    texts += [passage + " " + t for t in texts[3:6]] + [texts[7] + "\n" + passage]
    texts += ["line one here\nline one here\nother\n\nline one here", "😀 ünï<|endoftext|>côdé ٣٤ 中文", "\x00\x85　 nul", prose(rng, 4000, vocabulary)]
    return texts


def table(spark, texts, ids=None, sources=None, clashes=True):
    """documents with the given texts; ids may be null or repeat."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"src{(i or 0) % 3}" for i in ids] if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)]
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    if clashes:
        rows = [(*r, *["clash"] * len(CLASHES)) for r in rows]
        ddl += "".join(f", {c} string" for c in CLASHES)
    return spark.createDataFrame(rows, ddl)


def empty(spark):
    return table(spark, [])
