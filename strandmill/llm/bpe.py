"""Byte-level BPE without a merge loop: a backtracking encoder and an offset-table decoder.

Encoder: an Aho-Corasick automaton over the vocabulary gives the longest token at every position of a pre-token. The
encoder takes the longest token that is compatible with the one before, falls back to shorter ones and, where
none is left, takes the last token back. A pair is compatible if merging the two tokens' own bytes by rank
would leave exactly these two tokens; a text split into compatible neighbours is what the merges give, so the
result is exact, and every position fails at most once, so the time is linear.

Decoder: all tokens' bytes lie in one array; ids index a table of offsets.

Defined results: a null text is empty and has no tokens; very long texts are encoded whole, each pre-token in linear time; repeated rows stay;
special tokens' strings inside a text are special tokens; other columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import tempfile
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from strandmill.llm.textspans import CHUNK, chunks, texts_of
from strandmill.session import ship_package

#: Below this code point Unicode versions agree about letters, numbers and spaces. Other texts are split by the library's own pre-tokenizer.
_STABLE = 0x530
_BEYOND = re.compile(f"[{chr(_STABLE)}-\U0010ffff]")


def _ranges(kind: str) -> str:
    """The stable code points of a class, as the inside of a character set."""
    listed = [c for c in range(_STABLE) if regex.match(kind, chr(c))]
    firsts = [c for c in listed if c - 1 not in set(listed)]
    lasts = [c for c in listed if c + 1 not in set(listed)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts, strict=True))


def _pattern() -> re.Pattern:
    """The split that byte-level BPE of this family makes before merging, with its classes spelled out for the faster engine."""
    letter, number, space = _ranges(r"\p{L}"), _ranges(r"\p{N}"), _ranges(r"\s")
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


PATTERN = _pattern()
_BYTE_LEVEL = ByteLevel(add_prefix_space=False)
#: Pre-tokens that a worker remembers; past that it forgets them all.
CACHE = 500_000


def byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte: printable ones stand for themselves, the rest follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(text: str) -> list[str]:
    """The pre-tokens of a text without special tokens."""
    if _BEYOND.search(text):
        return [text[a:b] for _, (a, b) in _BYTE_LEVEL.pre_tokenize_str(text)] if text else []
    return PATTERN.findall(text)


class Vocabulary:
    def __init__(self, spec: dict):
        letters = byte_letters()
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.token = {i: bytes(letters[c] for c in t) for t, i in ids.items() if all(c in letters for c in t)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.special.items():
            self.token[i] = content.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.made_at: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = ids[a], ids[b], ids[a + b]
            self.rank.setdefault((left, right), rank)
            if whole not in self.halves:
                self.halves[whole] = (left, right)
                self.made_at[whole] = rank
        reachable = {ids[c] for c in letters} | self.halves.keys()
        self.by_bytes = {self.token[i]: i for i in sorted(reachable, reverse=True)}
        self.automaton = ahocorasick.Automaton()
        for raw, i in self.by_bytes.items():
            self.automaton.add_word(raw.decode("latin-1"), (len(raw), i))
        self.automaton.make_automaton()
        self.size = [0] * (max(self.token) + 1)
        for i, raw in self.token.items():
            self.size[i] = len(raw)
        self.shorter: dict[int, int | None] = {}
        self.compatible = functools.lru_cache(1 << 16)(self._compatible)
        # Offset table: token i is bytes[start[i] : start[i] + length[i]].
        ordered = [self.token.get(i, b"") for i in range(max(self.token) + 1)]
        self.length = np.array([len(x) for x in ordered], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter:
            raw = self.token[token]
            self.shorter[token] = next((self.by_bytes[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in self.by_bytes), None)
        return self.shorter[token]

    def _compatible(self, left: int, right: int) -> bool:
        """Would merging the bytes of both tokens, side by side, end with exactly these two?

        The two merge trees are undone from the outside in, the later merge first. Whenever both inner parts
        stand side by side, a pair of theirs with a rank before the merge undone last would have crossed the border.
        """
        made, halves, rank = self.made_at, self.halves, self.rank
        limit: tuple[int, int] = (1 << 60, 0)
        while True:
            across = rank.get((left, right))
            if across is not None and (across, 0) < limit:
                return False
            a, b = made.get(left, -1), made.get(right, -1)
            if a < 0 and b < 0:
                return True
            # At equal ranks the leftmost merge goes first: a pair across the border wins against the right part's merge, not the left part's.
            if a >= 0 and (a > b or (a == b and left == right and b < 0)):
                limit, left = (a, 0), halves[left][1]
            else:
                limit, right = (b, 1), halves[right][0]

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one pre-token."""
        raw = piece.encode()
        whole = self.by_bytes.get(raw)
        n = len(raw)
        if n == 1:
            return [whole]
        longest: list[int] = [0] * n
        reach = [0] * n
        for end, (size, token) in self.automaton.iter(raw.decode("latin-1")):
            if size > reach[begin := end - size + 1]:
                reach[begin], longest[begin] = size, token
        open_at = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        size, compatible = self.size, self.compatible
        while True:
            end = at + size[token]
            if open_at[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                if end == n:
                    return out
                at, token = end, longest[end]
                continue
            shorter = self._shorter(token)
            if shorter is None:
                open_at[at] = 0
                token = out.pop()
                at -= size[token]
            else:
                token = shorter

    def split(self, text: str) -> list[str]:
        """Special tokens' texts and pre-tokens, in order; joined they are the text."""
        if not any(s in text for s in self.special):
            return pieces(text)
        out: list[str] = []
        for part in regex.split("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")", text):
            out.extend([part] if part in self.special else pieces(part))
        return out

    def encode(self, text: str) -> list[int]:
        return [i for p in self.split(text) for i in ([self.special[p]] if p in self.special else self.encode_piece(p))]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids by the offset table."""
        many = self.length[ids]
        ends = np.cumsum(many)
        source = np.repeat(self.start[ids] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)
        return self.bytes[source].tobytes()


class Packed(dict):
    """A worker's cache: pre-token -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in vocabulary.special.items()}
        super().__init__(self.special)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
            self.update(self.special)
        ids = np.array(self.vocabulary.encode_piece(piece), "<u4").tobytes()
        if len(piece) < 64:
            self[piece] = ids
        return ids


@functools.lru_cache(4)
def vocabulary(name: str) -> Vocabulary:
    """From a file that was shipped with the job."""
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return Vocabulary(json.load(f))


@functools.lru_cache(4)
def packed(name: str) -> Packed:
    return Packed(vocabulary(name))


def ship_vocabulary(docs: DataFrame, path: str) -> str:
    """Send the vocabulary file to the executors; its name there tells its content, so files of one name in two folders are two."""
    ship_package(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    with open(path, "rb") as f:
        content = f.read()
    name = f"{hashlib.sha256(content).hexdigest()}-{os.path.basename(path)}"
    if not any(x.rsplit("/", 1)[-1] == name for x in sc.listFiles):
        copy = os.path.join(tempfile.mkdtemp(prefix="strandmill-"), name)  # only the driver reads it, when it serves the file
        with open(copy, "wb") as f:
            f.write(content)
        sc.addFile(copy)
    return name


def _rows(batches: Iterator[pa.RecordBatch], make: Callable[[list[str]], dict]) -> Iterator[pa.RecordBatch]:
    """Batches of about a chunk of text, so that what is made of them stays small."""
    for batch in batches:
        texts = texts_of(batch.column(1))
        for low, high, *_ in chunks(texts):
            made = make(texts.slice(low, high - low).to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(low, high - low).cast(pa.int64()), **made})


ENCODED = "doc_id long, ids binary"
ROUND_TRIP = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per document ``doc_id`` and its ``ids``: little-endian unsigned 32-bit integers. A null text is empty; repeated rows stay."""
    name = ship_vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = packed(name)
        split, look = cache.vocabulary.split, cache.__getitem__
        yield from _rows(batches, lambda texts: {"ids": pa.array([b"".join(map(look, split(t))) for t in texts], pa.binary())})

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of :func:`encode` ``doc_id`` and ``text``; bytes that aren't UTF-8 become U+FFFD."""
    name = ship_vocabulary(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(name)
        for batch in batches:
            made: list[str] = []
            first = size = 0
            for row in range(batch.num_rows):
                made.append(v.decode(np.frombuffer(batch.column(1)[row].as_py() or b"", "<u4")).decode("utf-8", "replace"))
                size += len(made[-1])
                if size >= CHUNK or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(first, len(made)).cast(pa.int64()), "text": pa.array(made, pa.string())})
                    first, size, made = row + 1, 0, []

    return encoded.select(encoded["doc_id"].cast("long"), encoded["ids"].cast("binary")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the decoded text, in one pass."""
    name = ship_vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = packed(name)
        v, split, look = cache.vocabulary, cache.vocabulary.split, cache.__getitem__

        def make(texts: list[str]) -> dict:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in texts:
                ids = b"".join(map(look, split(text)))
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                decoded = v.decode(np.frombuffer(ids, "<u4")).decode("utf-8", "replace")
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            return out

        yield from _rows(batches, make)

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, ROUND_TRIP)
