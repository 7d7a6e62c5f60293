"""Lists of nodes as compressed blocks of bytes: two-step work on a graph ships lists, not one row for every way.

A graph's edges become one packed list of targets for each source node. Consecutive rows of a table share a block, and a block gets each list that any
of its rows needs once, packed; a list is unpacked where a row uses it. So the shuffle grows with lists times blocks, memory with one
block's packed lists and one row's unpacked ones. Names must not end in a zero byte.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.session import ship_package, spill

#: Rows of a block: as a power of two.
BLOCK_BITS = 7
#: Names, or packed bytes, that a worker hands over at once, about.
CHUNK = 1 << 16
PACKED = 1 << 22
HEAD = struct.Struct("<QQ")


def matrix(names: pa.Array) -> np.ndarray:
    """UTF-8 bytes of names, a row each, with zeros behind shorter ones."""
    names = names.cast(pa.string())
    n = len(names)
    if n == 0:
        return np.zeros((0, 1), np.uint8)
    offsets = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + n + 1]
    data = np.frombuffer(names.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    width = max(int(lengths.max()), 1)
    if int(lengths.min()) == width:
        return data.reshape(n, width)
    rows = np.zeros((n, width), np.uint8)
    rows[np.arange(width) < lengths[:, None]] = data
    return rows


def texts(rows: np.ndarray) -> pa.Array:
    """The names of a matrix as strings."""
    n, width = rows.shape
    if n and not rows[:, -1].all():
        full = np.where(rows != 0, np.arange(1, width + 1), 0).max(axis=1)
        ends, data = np.cumsum(full), rows[np.arange(width) < full[:, None]]
    else:
        ends, data = np.arange(1, n + 1) * width, rows
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def keys(rows: np.ndarray) -> np.ndarray:
    """The names of a matrix as byte strings of numpy."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def joined(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([p if p.shape[1] == width else np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def binary(rows: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])


def distinct(rows: np.ndarray) -> np.ndarray:
    """Each name once, in order of what comes first."""
    found = binary(rows).unique()
    return np.frombuffer(found.buffers()[1] or b"", np.uint8)[: len(found) * rows.shape[1]].reshape(len(found), rows.shape[1])


def pack(rows: np.ndarray) -> bytes:
    """Column by column, so that the equal leading letters of sorted names vanish."""
    return HEAD.pack(*rows.shape) + pa.compress(np.ascontiguousarray(rows.T).tobytes(), "zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    n, width = HEAD.unpack_from(packed)
    if n == 0:
        return np.zeros((0, width), np.uint8)
    raw = pa.decompress(packed[HEAD.size :], n * width, "zstd")
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T)


def pack_numbers(numbers: np.ndarray) -> bytes:
    return pack(np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8))


def unpack_numbers(packed: bytes) -> np.ndarray:
    return unpack(packed).reshape(-1).view("<i8")


def _packed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``v, w, length`` in order -> a row ``v, names, lengths`` for each v."""
    made: list[tuple[str, bytes, bytes]] = []
    now, held, size = None, [], 0

    def close() -> int:
        names, lengths = (pa.concat_arrays([x[k] for x in held]) for k in (0, 1))
        if lengths.null_count:
            raise ValueError(f"an edge from {now} has no length")
        made.append((now, pack(matrix(names)), pack_numbers(lengths.to_numpy(zero_copy_only=False))))
        return len(made[-1][1]) + len(made[-1][2])

    def told() -> pa.RecordBatch:
        v, names, lengths = zip(*made, strict=True)
        return pa.RecordBatch.from_pydict({"v": pa.array(v, pa.string()), "names": pa.array(names, pa.binary()), "lengths": pa.array(lengths, pa.binary())})

    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column(0))
        begin = 0
        for v, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
            if v != now:
                if held:
                    size += close()
                now, held = v, []
            held.append((batch.column(1).slice(begin, end - begin), batch.column(2).slice(begin, end - begin)))
            begin = end
        if size > PACKED:
            yield told()
            made, size = [], 0
    if held:
        close()
    if made:
        yield told()


def target_lists(edges: DataFrame) -> DataFrame:
    """``block, v, names, lengths``: all targets of each node in order of name and length, packed, written to the shared folder.

    edges: ``v, w, length``. Edges without an end are left out; one without a length raises.
    """
    ship_package(edges.sparkSession)
    rows = edges.select("v", "w", F.col("length").cast("long").alias("length")).filter("v IS NOT NULL AND w IS NOT NULL")
    ordered = rows.repartitionByRange("v").sortWithinPartitions("v", "w", "length")
    return spill(ordered.mapInArrow(_packed_runs, "v string, names binary, lengths binary").select(block(), "v", "names", "lengths"))


def block() -> Column:
    """Of a table whose rows are in order: a number that neighbours share. To be written before it is used twice."""
    return F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``block, names`` -> ``block, via``: each name once for a block and batch."""
    for batch in batches:
        wanted: dict[int, list[np.ndarray]] = {}
        for b, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            wanted.setdefault(b, []).append(unpack(names))
        for b, parts in wanted.items():
            via = texts(distinct(joined(parts)))
            yield pa.RecordBatch.from_pydict({"block": pa.array([b] * len(via), pa.int64()), "via": via})


def map_with_lists(groups: DataFrame, lists: DataFrame, run: Callable[[Iterator[tuple]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``run`` over the rows of ``groups`` with the lists of the nodes that their ``names`` tell.

    groups: ``block, v, names`` and two more, ``avoid`` (string) and ``more`` (binary). lists: of :func:`target_lists`.
    run: an iterator of (v, avoid, names, more, the block's lists by name) -> an iterator of record batches.
    """
    wanted = groups.select("block", "names").mapInArrow(_named, "block long, via string").distinct()
    found = wanted.join(lists.select("v", "names", "lengths"), F.col("via") == F.col("v"))
    none = F.lit(None)
    rows = found.select("block", F.lit(0).alias("kind"), "v", none.cast("string").alias("avoid"), "names", F.col("lengths").alias("more")).unionByName(
        groups.select("block", F.lit(1).alias("kind"), "v", "avoid", "names", "more")
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, held = None, {}
        for batch in batches:
            for b, kind, v, avoid, names, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != now:
                    now, held = b, {}
                if kind == 0:
                    held[v.encode()] = names, more
                else:
                    yield v, avoid, names, more, held

    return rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(lambda batches: run(each(batches)), schema)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for v, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield from arrays([(v, None, unpack(names))])


def arrays(rows: list[tuple[str, str | None, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows ``v, avoid, nodes`` with lists of ``CHUNK`` names at most."""
    for v, avoid, names in rows:
        for k in range(0, len(names), CHUNK):
            nodes = texts(names[k : k + CHUNK])
            one = pa.ListArray.from_arrays(pa.array([0, len(nodes)], pa.int32()), nodes)
            yield pa.RecordBatch.from_pydict({"v": pa.array([v], pa.string()), "avoid": pa.array([avoid], pa.string()), "nodes": one})


ARRAYS = "v string, avoid string, nodes array<string>"


def unpacked(lists: DataFrame) -> DataFrame:
    """``v, w`` of packed lists ``v, names``."""
    return lists.select("v", "names").mapInArrow(_unpacked, ARRAYS).select("v", F.explode("nodes").alias("w"))
