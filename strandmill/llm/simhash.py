"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 3 bits differ in at most 2 outside one of three blocks of bits (21, 21, 22): leave
out the block with the most. So every fingerprint emits, for each block left out, all variants of the other
bits within half that radius, 1: itself and each single flip, 131 keys in all. Close fingerprints meet in a key.

What meets is verified without comparing all pairs. Members of one key are at most 2 apart outside the block, so
equal blocks, or blocks that differ in one bit, link; and where all three bits are in the block, the rest is equal and
the blocks' own balls meet. Each key emits a star for every set it has linked, never its pairs, and connected
components give the classes. Only distinct fingerprints go through this; documents join by theirs afterwards.

Defined results: a null text is empty; texts without words share the fingerprint 0; very long texts are read whole; repeated rows stay; a null
doc_id is never a component's id unless all are null; other columns, whatever their names, are ignored or passed through; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill.llm.rowkeys import with_row_key
from strandmill.llm.textspans import texts_of
from strandmill.operators.components import connected_components
from strandmill.session import settle, ship_package, spill

SEED = 42
SHINGLE = 3
RADIUS = 3
#: (lowest bit, bits) of the blocks that are left out in turn.
BLOCKS = ((0, 21), (21, 21), (42, 22))
N_KEYS = sum(64 - bits + 1 for _, bits in BLOCKS)
KEYS_PER_TASK = 1 << 20

_hash = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
_ALL = (1 << 64) - 1


def _block_mask(j: int) -> int:
    low, bits = BLOCKS[j]
    return ((1 << bits) - 1) << low


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text; bytes.lower and bytes.split know ASCII alone."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(len(words) - size + 1, 1)
    shingles = map(b" ".join, zip(*[words[k:] for k in range(size)], strict=False)) if len(words) >= size else [b" ".join(words)]
    hashes = np.fromiter(map(_hash, shingles), np.uint64, n).astype(">u8").view(np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for low in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[low : low + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [_signed(fingerprint(t.as_buffer().to_pybytes())) for t in texts_of(batch.column(2))]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "row": batch.column(1), "fp": pa.array(made, pa.int64())})


def fingerprints(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """``doc_id, row, fp``: the fingerprint as a signed long; ``row`` tells rows apart."""
    ship_package(docs.sparkSession)
    row = F.monotonically_increasing_id() if row is None else row
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), row.alias("row"), docs["text"].cast("string").alias("text")).mapInArrow(
        _fingerprints, "doc_id long, row long, fp long"
    )


def ball_keys(distinct: DataFrame) -> DataFrame:
    """``fp`` -> ``j, key, fp``: for each block left out the other bits and their single flips."""
    masks = []
    for j in range(len(BLOCKS)):
        keep = _ALL ^ _block_mask(j)
        masks += [(j, keep, 0), *[(j, keep, 1 << b) for b in range(64) if keep >> b & 1]]
    told = F.array(*[F.struct(F.lit(j).cast("byte").alias("j"), F.lit(_signed(k)).alias("keep"), F.lit(_signed(f)).alias("flip")) for j, k, f in masks])
    return distinct.select("fp", F.explode(told).alias("m")).select(
        F.col("m.j").alias("j"), F.col("fp").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("key"), "fp"
    )


class _Sets:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(y, y)
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _flips(j: int) -> list[int]:
    low, bits = BLOCKS[j]
    return [1 << b for b in range(low, low + bits)]


def link_members(j: int, key: int, members: list[int]) -> list[tuple[int, int]]:
    """Star edges among the distinct fingerprints (unsigned) that share a key."""
    mask = _block_mask(j)
    sets = _Sets()
    by_block: dict[int, int] = {}
    for fp in members:
        sets.join(by_block.setdefault(fp & mask, fp), fp)
    flips = _flips(j)
    if len(by_block) > 1:
        for r, fp in by_block.items():
            for f in flips:
                if (other := by_block.get(r ^ f)) is not None:
                    sets.join(fp, other)
        rest = key & ~mask
        exact = {fp & mask: fp for fp in members if fp & ~mask == rest}
        if len(exact) > 1:
            near: dict[int, list[int]] = {}
            for r, fp in exact.items():
                for f in (0, *flips):
                    first = near.setdefault(r ^ f, fp)
                    sets.join(first, fp)  # both within 1 of this value: at most 2 apart
            for r, fp in exact.items():
                for i, f in enumerate(flips):
                    for g in flips[:i]:
                        if (other := near.get(r ^ f ^ g)) is not None:
                            # 2 from here, 1 from there: at most 3 apart
                            sets.join(fp, other)
    return [(root, fp) for fp in members if (root := sets.find(fp)) != fp]


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (j, key): groups may run on into the next batch."""
    held: tuple[int, int] | None = None
    members: list[int] = []
    seen: set[tuple[int, int]] = set()

    def told() -> pa.RecordBatch:
        pairs = [(_signed(a), _signed(b)) for a, b in seen]
        seen.clear()
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    for batch in batches:
        j = batch.column(0).to_numpy()
        key = batch.column(1).to_numpy()
        fps = batch.column(2).to_numpy().view(np.uint64)
        if not len(j):
            continue
        cut = np.flatnonzero((j[1:] != j[:-1]) | (key[1:] != key[:-1])) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(j)]])
        whole = np.ones(len(first), bool)
        whole[[0, -1]] = False
        two = np.flatnonzero(whole & (last - first == 2))
        a, b = fps[first[two]], fps[first[two] + 1]
        close = np.bitwise_count(a ^ b) <= RADIUS
        seen.update(zip(np.minimum(a, b)[close].tolist(), np.maximum(a, b)[close].tolist(), strict=True))
        for i in np.flatnonzero(~whole | (last - first > 2)).tolist():
            low, high = int(first[i]), int(last[i])
            name = (int(j[low]), int(key[low]) & _ALL)
            if held is not None and held != name:
                seen.update(link_members(*held, members))
                members = []
            held = name
            members.extend(fps[low:high].tolist())
        if len(seen) > 100_000:
            yield told()
    if held is not None:
        seen.update(link_members(*held, members))
    yield told()


def close_links(distinct: DataFrame) -> DataFrame:
    """``a, b``: links that connect all fingerprints at most 3 bits apart (a spanning set, not all pairs)."""
    ship_package(distinct.sparkSession)
    group = W.partitionBy("j", "key")
    met = ball_keys(distinct).withColumn("n", F.count(F.lit(1)).over(group)).filter("n > 1").select("j", "key", "fp")
    return met.mapInArrow(_link, "a long, b long").distinct()


def _classes(docs: DataFrame, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row, fp, class`` and, per class, its first document: ``c_class, keep``."""
    rows = settle(fingerprints(docs, row))
    distinct = settle(rows.select("fp").distinct())
    # Each fingerprint becomes 131 rows in the next step: tasks are dealt by what they make, not by what they read.
    parts = max(distinct.sparkSession.sparkContext.defaultParallelism, -(-distinct.count() * N_KEYS // KEYS_PER_TASK))
    labels = connected_components(close_links(distinct.repartition(parts)))
    classed = settle(rows.join(labels, rows["fp"] == labels["node"], "left").select("doc_id", "row", "fp", F.coalesce("label", "fp").alias("class")))
    # Settled first: the join then has plain exchanges on both sides, and a hot class's rows can be split.
    me = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    return classed, settle(classed.groupBy(F.col("class").alias("c_class")).agg(F.min(me).alias("keep")))


def near_dedup(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, fingerprint`` (16 hex digits) and ``component_id``."""
    classed, first = _classes(docs)
    return classed.join(first, F.col("class") == F.col("c_class"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("keep.doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Of every component the first document by doc_id, with the columns of ``docs``.

    Rows go by their own key, so null and repeated ids are no matter; texts are only moved if the table of those that go is too large to broadcast.
    """
    keyed, key = with_row_key(docs)
    classed, first = _classes(keyed, keyed[key])
    gone = classed.join(first, F.col("class") == F.col("c_class")).filter("row <> keep.row").select(F.col("row").alias(key))
    return keyed.join(spill(gone), key, "left_anti").select(*docs.columns)
