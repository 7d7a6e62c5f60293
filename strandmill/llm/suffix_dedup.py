"""Removal of repeated passages with a sparse, distributed suffix array.

A passage is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Not every suffix needs
sorting for that: each window of LENGTH bytes has an anchor, its smallest ``K``-byte string by hash (the leftmost at
ties), and equal windows have equal anchors at equal places. Consecutive windows with one anchor form a run.

1. Scan: one row for each run (anchor's hash, digest of the run's text, place), about 1 in 80 bytes. Equal runs of a document at equal
   distances, as periodic texts have them, are one row with their number and distance.
2. Anchors that occur once can't be in a repeated window: a count by hash, combined map-side, leaves the others.
   Equal runs are counted together, and only one of them goes on, with its count.
3. Sort: suffixes at the anchors, cut to what the run's windows cover, are sorted in runs, front-coded and exchanged by the
   hash of their first K bytes; loser trees merge the runs without comparing known prefixes again. The order and its
   common prefixes are the suffix array and its LCP table, a part of it per hash.
4. Extents: neighbours with a common prefix R and a common left context of L bytes share the windows that begin 200 - R to L
   bytes before the anchor. A run that occurs twice shares all of its windows.
5. Anchors with more than ``CROWD`` different runs (a passage in very many documents, each with another surrounding)
   would hold more than about 25 MB in one task; their windows are counted by hash instead, combined map-side.
6. Runs take their extents back to all documents, where bytes are removed.

Defined results: a null text is empty; very long texts are scanned whole, in pieces that overlap; repeated rows are documents of their own (and so
repeat each other); null or repeated ids are replaced by row numbers inside; ties between equal runs don't matter, all of them go; other columns,
whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.llm.merge_runs import common, front_code, merge, read_run
from strandmill.llm.rowkeys import has_plain_ids
from strandmill.llm.textspans import RollingHash, chunks, owner, texts_of
from strandmill.session import settle, ship_package, spill

LENGTH = 200
K = 48
CROWD = 1 << 16
#: Longer texts are scanned in pieces; neighbouring pieces share LENGTH - 1 bytes.
PIECE = 1 << 22
#: Suffixes for one merge, about; suffixes that a task sorts at once.
PART = 8192
RUN = 1 << 17
#: Bits for positions below the hash that anchors are ordered by. PIECE + LENGTH and a chunk must fit.
_POSITION = np.uint64(24)

#: meta, from the lowest bits on: windows and bytes from the first window to the anchor (8 bits each), distance between equal runs (8), and
#: how many more of them follow (32).
ANCHORS = "row long, h long, c long, start long, meta long"
_TIMES = "shiftright(meta, 24) + 1"


def _runs(data: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...] | None:
    """Runs of windows: anchor's hash, digest, first window, windows, bytes from the first window to the anchor."""
    n, w = len(data), length - k + 1
    if n < length:
        return None
    hashes = RollingHash(data)
    at = np.arange(n - k + 1)
    h = hashes.quick(at, at + k)  # equal hashes of different anchors only sort together
    value = (h >> _POSITION << _POSITION) | at.astype(np.uint64)
    padded = np.full(-(-len(at) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(at)] = value
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n_windows = n - length + 1
    least = np.minimum(behind[:n_windows], ahead[w - 1 : w - 1 + n_windows])
    inside = np.ones(n_windows, bool)
    for end in offsets[1:-1].tolist():
        inside[max(end - length + 1, 0) : end] = False
    first = np.flatnonzero(inside)
    if not len(first):
        return None
    anchor = (least[first] & ((np.uint64(1) << _POSITION) - np.uint64(1))).astype(np.int64)
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1] + 1)) + 1
    low, high = first[np.concatenate([[0], cut])], first[np.concatenate([cut - 1, [len(first) - 1]])]
    anchor = anchor[np.concatenate([[0], cut])]
    digest = hashes.spans(low, high + length) + (anchor - low).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return h[anchor], digest, low, high - low + 1, anchor - low


def _periodic(text: np.ndarray, h: np.ndarray, c: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal runs of a text at one distance, no further apart than windows reach: the first of each series, the distance, how many follow it."""
    order = np.lexsort((start, c, h, text))
    gap = np.diff(start[order], append=0)
    alike = np.zeros(len(order), bool)
    for key in (text, h, c):
        alike[:-1] |= key[order][1:] != key[order][:-1]
    alike = ~alike & (gap <= length) & (gap < 256)
    alike[-1:] = False
    # A series goes on from a row to the next one if they are alike and the distance is the one before it, or none is.
    goes = alike.copy()
    goes[1:] &= ~alike[:-1] | (gap[1:] == gap[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~goes[:-1]]))
    more = np.diff(np.append(first, len(order))) - 1
    return order[first], np.where(more > 0, gap[first], 0), more


def _scan(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for low, _, data, offsets in chunks(texts_of(batch.column(1))):
                long = len(offsets) == 2 and len(data) > PIECE
                for at in range(0, len(data), PIECE) if long else (0,):
                    part, edges = (data[at : at + PIECE + length - 1], None) if long else (data, offsets)
                    found = _runs(part, np.array([0, len(part)]) if long else edges, length, k)
                    if found is None:
                        continue
                    h, c, start, windows, lead = found
                    text = np.zeros(len(h), np.int64) if long else owner(offsets, start)
                    one, gap, more = _periodic(text, h, c, start, length)
                    text, h, c, start = text[one], h[one], c[one], start[one]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": rows[low + text], "h": h.view(np.int64), "c": c.view(np.int64),
                            "start": start + at - (0 if long else offsets[text]), "meta": more << 24 | gap << 16 | lead[one] << 8 | windows[one],
                        }
                    )

    return run


def _contexts(batch: pa.RecordBatch, length: int) -> Iterator[tuple]:
    """(text, h, c, start, lead, windows, n) of each run whose text is asked for."""
    texts, asked = texts_of(batch.column(0)), batch.column(1)
    for i in range(batch.num_rows):
        text = texts[i].as_buffer().to_pybytes()
        for r in asked[i].as_py():
            yield text, r["h"], r["c"], r["start"], r["meta"] >> 8 & 255, r["meta"] & 255, r["n"]


def _sorted_runs(length: int, parts: int):
    """Texts with their runs -> front-coded blocks of sorted suffixes, for part h mod ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        n_held = 0

        def blocks() -> pa.RecordBatch:
            for rows in held.values():
                rows.sort()
            return pa.RecordBatch.from_pydict({"part": pa.array(list(held), pa.int32()), "block": pa.array([front_code(r) for r in held.values()], pa.binary())})

        for batch in batches:
            for text, h, c, start, lead, windows, n in _contexts(batch, length):
                anchor = start + lead
                suffix = text[anchor : start + windows - 1 + length]
                held.setdefault(h % parts, []).append((suffix, text[start:anchor][::-1], h, c, lead - windows + 1, n))
                n_held += 1
            if n_held >= RUN:
                yield blocks()
                held, n_held = {}, 0
        yield blocks()

    return run


def extents(group: list[tuple[int, bytes, tuple]], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(h, c, [low, high, ...]) for suffixes with one anchor, in order: the bytes before the anchor at which repeated windows begin.

    Neighbours in suffix order are united from the longest common prefix down. In a united set all share a prefix of R bytes, and
    of all others a suffix shares the longest left context L with a neighbour in the order of left contexts; the
    smaller set is put into the larger one's order, and only who gets a new neighbour has anything new to tell. So a group of
    m suffixes takes m log m insertions, not m * m comparisons.
    """
    least = [row[2][3] for row in group]
    lefts = [row[2][0] for row in group]
    found: list[list[tuple[int, int]]] = [[] for _ in group]

    def tell(i: int, right: int, left: int) -> None:
        low, high = max(least[i], length - right), min(len(lefts[i]), left)
        if low <= high:
            found[i].append((low, high))

    members = {i: [(lefts[i], i)] for i in range(len(group))}
    up = list(range(len(group)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for at in sorted(range(1, len(group)), key=lambda i: -group[i][0]):
        right = group[at][0]
        small, large = root(at - 1), root(at)
        if len(members[small]) > len(members[large]):
            small, large = large, small
        order = members[large]
        for entry in members.pop(small):
            place = bisect.bisect_left(order, entry)
            left_before = common(order[place - 1][0], entry[0]) if place else -1
            left_after = common(order[place][0], entry[0]) if place < len(order) else -1
            tell(entry[1], right, max(left_before, left_after))
            if place:
                tell(order[place - 1][1], right, left_before)
            if place < len(order):
                tell(order[place][1], right, left_after)
            order.insert(place, entry)
        up[small] = large

    for (_, _, (left, h, c, low, n)), spans in zip(group, found, strict=True):
        if n > 1:
            yield h, c, [low, len(left)]
        elif spans:
            spans.sort()
            flat = list(spans[0])
            for a, b in spans[1:]:
                if a > flat[-1] + 1:
                    flat += [a, b]
                else:
                    flat[-1] = max(flat[-1], b)
            yield h, c, flat


def _merge_parts(length: int, k: int):
    """Blocks in order of their part -> extents."""

    def part(blocks: list[bytes]) -> pa.RecordBatch:
        out: list[tuple[int, int, list[int]]] = []
        group: list[tuple[int, bytes, tuple]] = []
        for row in merge([read_run(b) for b in blocks]):
            if row[0] < k and group:
                out.extend(extents(group, length))
                group = []
            group.append(row)
        out.extend(extents(group, length))
        return pa.RecordBatch.from_pydict(
            {"h": pa.array([x[0] for x in out], pa.int64()), "c": pa.array([x[1] for x in out], pa.int64()), "found": pa.array([x[2] for x in out], pa.list_(pa.int32()))}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, blocks = None, []
        for batch in batches:
            for p, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != name and blocks:
                    yield part(blocks)
                    blocks = []
                name = p
                blocks.append(b)
        if blocks:
            yield part(blocks)

    return run


def _window_hashes(length: int):
    """Texts with runs of crowded anchors -> the hash of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, h, c, start, lead, windows, n in _contexts(batch, length):
                data = np.frombuffer(text, np.uint8)[start : start + windows - 1 + length]
                at = np.arange(windows)
                rows.append((h, c, n, lead, RollingHash(data).spans(at, at + length).view(np.int64)))
            yield pa.RecordBatch.from_pydict(
                {
                    "h": pa.array([r[0] for r in rows], pa.int64()), "c": pa.array([r[1] for r in rows], pa.int64()),
                    "n": pa.array([r[2] for r in rows], pa.int64()), "lead": pa.array([r[3] for r in rows], pa.int32()),
                    "hashes": pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                }
            )

    return run


def merged_spans(found: list[dict], length: int) -> list[tuple[int, int]]:
    """Byte spans, merged, from runs with their extents."""
    spans = []
    for r in found:
        anchor = r["start"] + (r["meta"] >> 8 & 255)
        further = (r["meta"] >> 24) * (r["meta"] >> 16 & 255)  # the equal runs that follow begin no further apart than a window is long
        pairs = r["found"]
        spans += [(anchor - pairs[i + 1], anchor - pairs[i] + length + further) for i in range(0, len(pairs), 2)]
    spans.sort()
    out: list[tuple[int, int]] = []
    for low, high in spans:
        if out and low <= out[-1][1]:
            if high > out[-1][1]:
                out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = texts_of(batch.column(1)), batch.column(2).to_pylist()
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "spans": [], "kept_sha256": []}
            for i in range(batch.num_rows):
                text = texts[i].as_buffer().to_pybytes()
                spans = merged_spans(found[i] or [], length)
                digest, at = hashlib.sha256(), 0
                for low, high in spans:
                    digest.update(text[at:low])
                    at = high
                digest.update(text[at:])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(sum(b - a for a, b in spans))
                out["spans"].append([{"begin": a, "end": b} for a, b in spans])
                out["kept_sha256"].append(digest.hexdigest())
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).cast(pa.int64()), **out, "spans": pa.array(out["spans"], kind)})

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, crowd: int = CROWD) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, spans array<struct<begin, end>>, kept_sha256``."""
    spark = docs.sparkSession
    ship_package(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if has_plain_ids(slim):
        texts = slim.select(F.col("doc_id").alias("row"), "doc_id", "text")
    else:
        texts = spill(slim.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))

    # Both joins of the texts below take the same columns and the same filter, so that one exchange serves them.
    texts = texts.filter("row IS NOT NULL")
    anchors = spill(texts.select("row", "text").mapInArrow(_scan(length, k), ANCHORS))
    # Written first, so that the join has plain exchanges on both sides and a hot anchor's rows can be split.
    twice = spill(anchors.groupBy("h").agg(F.sum(F.expr(_TIMES)).alias("n")).filter("n > 1").select("h"))
    live = spill(anchors.join(twice, "h", "left_semi"))
    runs = spill(
        live.groupBy("h", "c").agg(F.sum(F.expr(_TIMES)).alias("n"), F.min(F.struct("row", "start", "meta")).alias("at")).select("h", "c", "n", "at.*")
    )
    crowds = settle(runs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("h"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // PART))

    def asked(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("row").agg(F.collect_list(F.struct("h", "c", "start", "meta", "n")).alias("asked"))
        return texts.join(wanted, "row").select("text", "asked", "doc_id")

    blocks = asked(runs.join(crowds, "h", "left_anti")).mapInArrow(_sorted_runs(length, parts), "part int, block binary")
    sorted_extents = blocks.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_merge_parts(length, k), "h long, c long, found array<int>")

    hashed = asked(runs.join(crowds, "h", "left_semi")).mapInArrow(_window_hashes(length), "h long, c long, n long, lead int, hashes array<long>")
    windows = hashed.select("h", "c", "n", "lead", F.posexplode("hashes").alias("i", "w"))
    shared = windows.groupBy("w").agg(F.sum("n").alias("times")).filter("times > 1").select("w")
    offset = F.col("lead") - F.col("i")
    crowded_extents = (
        windows.join(shared, "w", "left_semi")
        .groupBy("h", "c")
        .agg(F.flatten(F.collect_list(F.array(offset, offset))).alias("found"))
    )
    found = live.join(sorted_extents.unionByName(crowded_extents), ["h", "c"]).select("row", "start", "meta", "found")
    by_text = found.groupBy("row").agg(F.collect_list(F.struct("start", "meta", "found")).alias("found"))
    met = texts.join(by_text, "row", "left").select("doc_id", "text", "found")
    return met.mapInArrow(_remove(length), "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept_sha256 string")
