"""Token counts by a two-tier lookup on the map side.

First tier: a compact table of the lengths in tokens of frequent pre-tokens, at most ``TABLE`` of them, broadcast. A vocabulary holds what was
frequent where it was learnt, so its own entries fill the table, in the order in which they were learnt; no text is read for it. Second tier: each
worker encodes what it misses and remembers it, up to a bound. No pre-token is ever shuffled, and what is in the table has
no influence on the counts, only on the time.

Defined results: a null text is empty and has 0 tokens; very long texts are counted whole; repeated rows stay; ties don't arise; other columns,
whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.llm.bpe import CACHE, Vocabulary, _rows, ship_vocabulary, vocabulary

#: Entries of the broadcast table (under 2 MB).
TABLE = 1 << 16
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


class Lengths(dict):
    """Pre-token -> number of tokens: the broadcast tier, and what this worker has met since."""

    def __init__(self, v: Vocabulary, frequent: dict[str, int]):
        self.vocabulary, self.frequent = v, frequent | dict.fromkeys(v.special, 1)
        super().__init__(self.frequent)

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        n = len(self.vocabulary.encode_piece(piece))
        if len(piece) < 64:
            self[piece] = n
        return n


def pack(table: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """A table as one run of bytes, the ends of its keys, and its values."""
    keys = [k.encode() for k in table]
    return b"".join(keys), np.cumsum([len(k) for k in keys], dtype=np.uint32).tobytes(), np.array(list(table.values()), np.uint16).tobytes()


def unpack(packed: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    raw, ends, values = packed[0], np.frombuffer(packed[1], np.uint32).tolist(), np.frombuffer(packed[2], np.uint16).tolist()
    return {raw[a:b].decode(): n for a, b, n in zip([0, *ends], ends, values, strict=False)}


_tiers: dict[str, Lengths] = {}


def _worker_lengths(name: str, shipped: Broadcast, tag: str) -> Lengths:
    """One per worker and broadcast; an older one goes."""
    if tag not in _tiers:
        _tiers.clear()
        _tiers[tag] = Lengths(vocabulary(name), unpack(shipped.value))
    return _tiers[tag]


def frequent_pieces(v: Vocabulary, table: int = TABLE) -> list[str]:
    """The vocabulary's entries that can be pre-tokens, under 64 letters, the first ``table`` of them by id."""
    found = []
    for _, raw in sorted(v.token.items()):
        try:
            piece = raw.decode()
        except UnicodeDecodeError:  # part of a letter
            continue
        if len(piece) < 64 and piece not in v.special and v.split(piece) == [piece]:
            found.append(piece)
        if len(found) == table:
            break
    return found


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_tokens, over_limit``."""
    name = ship_vocabulary(docs, path)
    with open(path, encoding="utf-8") as f:
        v = Vocabulary(json.load(f))
    table = {p: len(v.encode_piece(p)) for p in frequent_pieces(v)}
    compact = pack(table)
    shipped, tag = docs.sparkSession.sparkContext.broadcast(compact), hashlib.sha256(b"".join(compact)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _worker_lengths(name, shipped, tag)
        split, look = lengths.vocabulary.split, lengths.__getitem__

        def make(texts: list[str]) -> dict:
            return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": [sum(map(look, split(t))) for t in texts]}

        yield from _rows(batches, make)

    counted = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, SCHEMA)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
