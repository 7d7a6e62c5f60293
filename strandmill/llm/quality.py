"""Quality rules by repetition coverage.

Words, lines and word windows are hashed with rolling hashes (modulo 2^64 and modulo a prime) over whole Arrow buffers; the rules measure
which share of a text's characters lies inside duplicated windows of 5 to 10 words, inside duplicated lines, and inside the
most frequent window of 2, 3 and 4 words if that occurs ``LEAST_TOPS`` times or more. The limits fall with the window's length and lie below what the
base rule allows: a text with 19 % of its words in duplicated windows of ten goes.

Defined results: a null or blank text has no words and fails the base rule; a repeated row is a document of its
own; a very long text is measured whole; of equally frequent windows the one with the most characters counts; other columns are ignored, whatever their names; an
empty table gives no rows. Nothing is shuffled. Memory: about 100 bytes for every byte of the longest text, at least of a half-megabyte chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandmill.llm.textspans import SPACE, RollingHash, chunks, mix, owner, repeated, span_bounds, texts_of
from strandmill.session import ship_package

#: The largest share of characters inside duplicated windows of n words, inside the most frequent window of n words, and inside
#: duplicated lines. One heading that a short text says twice stays below them.
MAX_WINDOW_SHARE = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.18, 9: 0.17, 10: 0.15}
MAX_TOP_SHARE = {2: 0.20, 3: 0.18, 4: 0.16}
LEAST_TOPS = 3
MAX_LINE_SHARE = 0.20
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, window_share double, line_share double, top_share double"
)


def _top_share(words: np.ndarray, text: np.ndarray, chars: np.ndarray, salt: np.ndarray, size: int, word_chars: np.ndarray) -> np.ndarray:
    """Per text the share of its characters that its most frequent window of ``size`` words takes, overlaps counted each time."""
    out = np.zeros(len(word_chars))
    at = np.arange(max(len(words) - size + 1, 0))
    at = at[text[at] == text[at + size - 1]] if len(at) else at
    if not len(at):
        return out
    key = salt[at]
    for k in range(size):
        key = mix(key + words[at + k])
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    many = np.diff(np.append(first, len(key)))
    often = many >= LEAST_TOPS
    at, many = at[order[first[often]]], many[often]
    size_of = sum(chars[at + k] for k in range(size))
    # Per text the largest count, then the most characters.
    best = np.lexsort((size_of, many, text[at]))
    owners = text[at][best]
    last = np.flatnonzero(np.append(owners[1:] != owners[:-1], True)) if len(owners) else np.zeros(0, np.int64)
    out[owners[last]] = (many * size_of)[best][last]
    return out / np.maximum(word_chars, 1)


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    solid = ~SPACE[data]
    letters = solid & ((data & 0xC0) != 0x80)
    upto = np.concatenate([[0], np.cumsum(letters)])
    word_chars = np.diff(upto[offsets])
    starts, ends = span_bounds(solid, offsets)
    text = owner(offsets, starts)
    n_words = np.bincount(text, minlength=n)
    hashes = RollingHash(data)

    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([breaks + 1, offsets[:-1]]))
    line_end = np.sort(np.concatenate([breaks, offsets[1:]]))
    worded = upto[line_end] > upto[line_start]
    line_start, line_end = line_start[worded], line_end[worded]
    line_text = owner(offsets, line_start)
    _, earlier = repeated(hashes.spans(line_start, line_end) ^ mix(line_text.astype(np.uint64) + np.uint64(1)))
    line_chars = (upto[line_end] - upto[line_start])[earlier]
    n_dup_lines = np.bincount(line_text[earlier], minlength=n)
    line_share = np.bincount(line_text[earlier], weights=line_chars, minlength=n) / np.maximum(word_chars, 1)

    words = hashes.spans(starts, ends)
    chars = upto[ends] - upto[starts]
    salt = mix(text.astype(np.uint64) + np.uint64(1))
    worst, top = np.zeros(n), np.zeros(n)
    bad = line_share > MAX_LINE_SHARE
    for size, most in MAX_TOP_SHARE.items():
        share = _top_share(words, text, chars, salt, size, word_chars)
        top = np.maximum(top, share)
        bad |= share > most
    at = np.arange(max(len(words) - 4, 0))
    at = at[text[at] == text[at + 4]] if len(at) else at
    n_repeat_words = np.zeros(n, np.int64)
    for size, most in MAX_WINDOW_SHARE.items():
        # A window of n words can only occur twice if its first n - 1 words do: only those are tried again.
        key = salt[at]
        for k in range(size):
            key = mix(key + words[at + k]) if k % 4 == 3 else (key + words[at + k]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(k + 1)
        at = at[repeated(mix(key))[0]]
        covered = np.zeros(len(words), bool)
        for k in range(size):
            covered[at + k] = True
        if size == 5:
            n_repeat_words = np.bincount(text[covered], minlength=n)
        share = np.bincount(text[covered], weights=chars[covered], minlength=n) / np.maximum(word_chars, 1)
        worst = np.maximum(worst, share)
        bad |= share > most
        at = at[at + size < len(words)]
        at = at[text[at] == text[at + size]] if len(at) else at
        if not len(at):
            break
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": per_text(_SYMBOL[data]), "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words, "base_failed": base_failed, "kept": ~base_failed & ~bad, "window_share": worst, "line_share": line_share, "top_share": top,
    }


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in chunks(texts_of(batch.column(1))):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(low, high - low).cast(pa.int64()), **_measure(data, offsets)})


def quality(docs: DataFrame) -> DataFrame:
    """Per document the counts and shares, ``base_failed`` and the verdict ``kept``."""
    ship_package(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(_run, SCHEMA)


def _keep(column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [_measure(data, offsets)["kept"] for *_, data, offsets in chunks(texts_of(batch.column(column)))]
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))

    return run


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is ``kept``, with the columns of ``docs``, in one pass without a shuffle. Null texts go."""
    ship_package(docs.sparkSession)
    return docs.mapInArrow(_keep(docs.columns.index("text")), docs.schema)
