"""Substring dedup: passages that documents share, edits allowed, by collinear chaining.

1. Seeds: five words whose middle word has the smallest hash of the five (an open syncmer: one place in five, chosen by its own words
   alone, so the same in every copy that holds them). A seed's sketch says what stands near: for three bands of words on either side, 8 to
   20 words wide and up to 40 words away, the smallest hash of two neighbouring words. Bands survive most edits.
2. Partners: occurrences of one seed are linked as a star, each with its leader: first inside a map task, then the tasks' leaders with
   each other. An occurrence nearly all of whose bands agree with its leader's is settled. The others, with the leaders that they didn't
   match, meet again under each (seed, band) in a second star: there only who has the same words near, 8 to 40 words away,
   shares a leader, whatever unrelated documents came first. So no pairs are made inside a group, a hot seed sends one
   entry a task and its other occurrences go out under their own contexts.
3. Chains: the matches of two documents are chained in order of both, with gap costs, through a Fenwick tree. A pair whose seeds and equal
   bands together don't reach over ``REACH`` words holds no passage.
4. Alignment: each chain is aligned word by word, a match earning 1 and an edit costing 4: the gaps between its seeds as a whole, and outwards
   from its ends until the score falls ``DROP`` below its best. The longest stretch that is ``MIN_WORDS`` long on both sides with a similarity
   of 0.8 or more is a passage, and so are such stretches before and after it. Texts come cut ``MARGIN`` words around the seeds; a pair
   whose alignment comes near a cut is aligned again with eight times as much, until none is.

Seeds travel as packed arrays, one block for each part and task, and are sorted by numpy: a row for each of them would cost several times as much.

Defined results: a null text is empty; texts shorter than ``MIN_WORDS`` words have no passages; a very long text is scanned whole; a repeated row is
a document of its own; null or repeated ids are replaced by row numbers inside; ties go to the smaller row; other columns, whatever
their names, are ignored; an empty table gives no rows. Passages are between documents; what repeats inside one is left to the
quality rules. Which member of a class is a row's partner depends on how rows are dealt to tasks; which documents share passages doesn't.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.llm.chaining import chains
from strandmill.llm.rowkeys import has_plain_ids
from strandmill.llm.textspans import SPACE, RollingHash, chunks, mix, owner, span_bounds, texts_of
from strandmill.session import release, ship_package, spill

SHINGLE = 5
#: Bands of a sketch: words past a seed's end, and as many before its begin.
BANDS = ((0, 8), (8, 20), (20, 40))
SIDES = len(BANDS)
#: So many of the six bands alike (or empty on both sides) settle an occurrence.
SETTLED = 5
REACH = 25
MIN_WORDS = 50
MIN_SIMILARITY = 0.8
EDIT_COST = 4
DROP = 48
#: Words that an alignment looks ahead for where both texts go on alike, and words that must be alike there.
LOOK = 12
ANCHOR = 3
#: Gaps between the seeds of a chain are aligned whole up to so many words; a wider one counts as edits.
WIDEST = 128
#: Words on either side of a chain that are brought along for its alignment at first, and by what they grow in the next round.
MARGIN = 2048
GROWTH = 8
GAP = 0.02
#: Of a run of the same seed only the first place and every so-manieth is told.
SAME = 4
#: Seeds that a scan holds before it tells its leaders; bytes of text whose seeds meet in one part, about.
RUN = 1 << 20
PART_BYTES = 1 << 24

#: An occurrence. key: the seed's hash, later that of seed and band. waits: others of its task match it not.
ENTRY = np.dtype([("key", "<u8"), ("row", "<i8"), ("at", "<i4"), ("sketch", "<u2", (2 * SIDES,)), ("waits", "u1")])
MATCH = np.dtype([("row", "<i8"), ("hub", "<i8"), ("at", "<i4"), ("hub_at", "<i4"), ("behind", "u1"), ("ahead", "u1")])
SEEDS, MATCHES, UNSETTLED, CONTEXTS = range(4)
BLOCKS = "part int, kind int, block binary"
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
_REACHES = np.array([high for _, high in BANDS], np.uint8)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each word; A-Z count as a-z."""
    data = _LOWER[data]
    starts, ends = span_bounds(~SPACE[data], offsets)
    return RollingHash(data).spans(starts, ends), owner(offsets, starts)


def _seeds(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in ``words`` and hash of each seed."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    middle = words[2 : 2 + n]
    chosen = text[:n] == text[SHINGLE - 1 :]
    for k in (0, 1, 3, 4):
        chosen &= middle <= words[k : k + n]
    at = np.flatnonzero(chosen)
    h = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        h = mix(h + words[at + k] + np.uint64(k + 1))
    if len(at) > 1:
        same = np.concatenate([[False], (h[1:] == h[:-1]) & (at[1:] == at[:-1] + 1) & (text[at[1:]] == text[at[:-1]])])
        told = ~same | (at % SAME == 0)
        at, h = at[told], h[told]
    return at, h


def _sketches(words: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each seed, band by band behind and then ahead, the smallest hash of two neighbouring words, in 16 bits; 0 for none."""
    pad = BANDS[-1][1] + SHINGLE
    low = np.full(len(words) + pad * (int(text[-1]) + 2) if len(words) else 0, _MAX, np.uint64)
    place = np.arange(len(words)) + pad * (text + 1)
    two = np.flatnonzero(text[1:] == text[:-1])
    low[place[two]] = mix(words[two] * np.uint64(0xBF58476D1CE4E5B9) + words[two + 1])
    wide, known = {1: low}, 1
    while known < BANDS[-1][1]:
        half = wide[known]
        wide[2 * known] = np.minimum(half[: len(half) - known], half[known:])
        known *= 2
    out = np.zeros((len(at), 2 * SIDES), np.uint16)
    first = place[at]
    for j, (near, far) in enumerate(BANDS):
        size = far - near - 1  # pairs of neighbours inside the band
        step = 1 << (size.bit_length() - 1)
        for k, begin in ((j, first - far), (SIDES + j, first + SHINGLE + near)):
            least = np.minimum(wide[step][begin], wide[step][begin + size - step])
            out[:, k] = np.where(least == _MAX, 0, np.maximum(least >> np.uint64(48), 1))
    return out


def _sorted(entries: np.ndarray) -> np.ndarray:
    """In order of key; equal keys in order of row and place."""
    keys = entries["key"].copy()
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    tied = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]])) if len(keys) else same
    some = order[tied]
    order[tied] = some[np.lexsort((entries["at"][some], entries["row"][some], keys[tied]))]
    return entries[order]


def star(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of occurrences in order of key, row and place: each one's leader (its group's first), the matches, and who is settled.

    A leader is settled. Another occurrence matches its leader if they are of two documents and a band agrees.
    """
    n = len(entries)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, MATCH), np.zeros(0, bool)
    new = np.concatenate([[True], entries["key"][1:] != entries["key"][:-1]])
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    follows = np.flatnonzero(~new)
    mine, its = entries[follows], entries[leader[follows]]
    alike = mine["sketch"] == its["sketch"]
    told = alike & (mine["sketch"] != 0)
    settled = np.ones(n, bool)
    settled[follows] = alike.sum(axis=1) >= SETTLED
    hit = (mine["row"] != its["row"]) & told.any(axis=1)
    out = np.zeros(int(hit.sum()), MATCH)
    for name, value in (("row", mine["row"]), ("hub", its["row"]), ("at", mine["at"]), ("hub_at", its["at"])):
        out[name] = value[hit]
    out["behind"] = (told[hit, :SIDES] * _REACHES).max(axis=1, initial=0)
    out["ahead"] = (told[hit, SIDES:] * _REACHES).max(axis=1, initial=0)
    turned = out["hub"] > out["row"]  # leaders of map tasks aren't always the smaller rows
    for a, b in (("row", "hub"), ("at", "hub_at")):
        out[a][turned], out[b][turned] = out[b][turned], out[a][turned].copy()
    return leader, out, settled


def _waiting(entries: np.ndarray, leader: np.ndarray, settled: np.ndarray) -> np.ndarray:
    """Marks the leaders that some follower isn't settled with."""
    entries["waits"][leader[~settled]] = 1
    return entries


def _dealt(kind: int, entries: np.ndarray, keys: np.ndarray, parts: int) -> list[tuple[int, int, bytes]]:
    """Entries as blocks, by part."""
    if not len(entries):
        return []
    part = ((keys >> np.uint64(7)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    entries, part = entries[order], part[order]
    cut = np.flatnonzero(part[1:] != part[:-1]) + 1
    return [(int(part[low]), kind, entries[low:high].tobytes()) for low, high in zip([0, *cut.tolist()], [*cut.tolist(), len(part)], strict=True)]


def _by_row(matches: np.ndarray, parts: int) -> list[tuple[int, int, bytes]]:
    return _dealt(MATCHES, matches, mix(matches["row"].view(np.uint64)), parts)


def _told(blocks: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, block = zip(*blocks, strict=True) if blocks else ((), (), ())
    return pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "kind": pa.array(kind, pa.int32()), "block": pa.array(block, pa.binary())})


def _scan(parts: int):
    """Texts -> leaders of this task's seeds by part of the seed, matches, and occurrences that their leaders don't settle."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        entries = _sorted(np.concatenate(held))
        leader, matches, settled = star(entries)
        first = leader == np.arange(len(entries))
        leads = _waiting(entries, leader, settled)[first]
        rest = entries[~settled]
        return _told(_dealt(SEEDS, leads, leads["key"], parts) + _by_row(matches, parts) + _dealt(UNSETTLED, rest, mix(rest["key"] + rest["row"].view(np.uint64)), parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n_held = 0
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for low, high, data, offsets in chunks(texts_of(batch.column(1))):
                words, text = _words(data, offsets)
                long = np.bincount(text, minlength=high - low) >= MIN_WORDS
                words, text = words[long[text]], text[long[text]]
                at, h = _seeds(words, text)
                if not len(at):
                    continue
                entries = np.zeros(len(at), ENTRY)
                entries["key"], entries["row"] = h, rows[low + text[at]]
                entries["at"] = at - np.searchsorted(text, text[at])
                entries["sketch"] = _sketches(words, text, at)
                held.append(entries)
                n_held += len(entries)
            if n_held >= RUN:
                yield flush(held)
                held, n_held = [], 0
        if held:
            yield flush(held)

    return run


def _contexts(entries: np.ndarray) -> np.ndarray:
    """Each occurrence under each of its bands, the key telling seed and band."""
    out = []
    for j in range(2 * SIDES):
        near = entries[entries["sketch"][:, j] != 0]
        near["key"] = mix(near["key"] + np.uint64((j + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1) ^ mix(near["sketch"][:, j].astype(np.uint64) + np.uint64(1)))
        out.append(near)
    return np.concatenate(out)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list[bytes]]]:
    """Rows in order of their part: the blocks of each, by kind."""
    name, blocks = None, {}
    for batch in batches:
        part, kind = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            if part[i] != name and blocks:
                yield blocks
                blocks = {}
            name = part[i]
            blocks.setdefault(kind[i], []).append(batch.column(2)[i].as_py())
    if blocks:
        yield blocks


def _array(blocks: list[bytes], kind: np.dtype) -> np.ndarray:
    return np.frombuffer(bytearray(b"".join(blocks)), kind) if blocks else np.zeros(0, kind)


def _meet(parts: int):
    """Leaders by seed -> matches, and contexts of all that is not settled, after a star of this part's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in _parts(batches):
            entries = _sorted(_array(blocks.get(SEEDS, []), ENTRY))
            leader, matches, settled = star(entries)
            # What a map task left waiting for another leader may find it in any of its seed's leaders that wait, or in the first one.
            entries["waits"][leader[entries["waits"] != 0]] = 1
            _waiting(entries, leader, settled)
            waiting = ~settled | (entries["waits"] != 0)
            near = _sorted(_contexts(np.concatenate([entries[waiting], _array(blocks.get(UNSETTLED, []), ENTRY)])))
            leader, more, _ = star(near)
            near = near[leader == np.arange(len(near))]
            out = _by_row(np.concatenate([matches, more, _array(blocks.get(MATCHES, []), MATCH)]), parts) + _dealt(CONTEXTS, near, near["key"], parts)
            yield _told(out)

    return run


def _meet_again(parts: int):
    """Leaders by context -> matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in _parts(batches):
            _, matches, _ = star(_sorted(_array(blocks.get(CONTEXTS, []), ENTRY)))
            yield _told(_by_row(np.concatenate([matches, _array(blocks.get(MATCHES, []), MATCH)]), parts))

    return run


CHAINS = "row long, hub long, x array<int>, y array<int>"


def _chain_pairs(found: np.ndarray) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """Matches of whole documents -> chains of the pairs that may hold a passage."""
    if not len(found):
        return
    found = found[np.lexsort([found[name].copy() for name in ("hub_at", "at", "hub", "row")])]
    first = np.flatnonzero(np.concatenate([[True], (found["row"][1:] != found["row"][:-1]) | (found["hub"][1:] != found["hub"][:-1])]))
    at, hub_at = found["at"].astype(np.int64), found["hub_at"].astype(np.int64)
    reach = np.maximum.reduceat(at + SHINGLE + found["ahead"], first) - np.minimum.reduceat(at - found["behind"], first)
    last = np.append(first[1:], len(found))
    for k in np.flatnonzero(reach >= REACH).tolist():
        low, high = int(first[k]), int(last[k])
        row, hub = int(found["row"][low]), int(found["hub"][low])
        places = np.unique(np.column_stack([at[low:high], hub_at[low:high]]), axis=0)
        dx, dy = np.diff(places[:, 0]), np.diff(places[:, 1])
        # All in order and each worth joining: then the best chain is all of them.
        if not len(dx) or (dx.min() > 0 and dy.min() > 0 and (GAP * (dx + dy)).max() < SHINGLE):
            yield row, hub, places[:, 0].tolist(), places[:, 1].tolist()
            continue
        listed = list(map(tuple, places.tolist()))
        for chain in chains(listed, SHINGLE, GAP):
            yield row, hub, [listed[i][0] for i in chain], [listed[i][1] for i in chain]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for blocks in _parts(batches):
        out = list(_chain_pairs(_array(blocks.get(MATCHES, []), MATCH)))
        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.array([o[0] for o in out], pa.int64()), "hub": pa.array([o[1] for o in out], pa.int64()),
                "x": pa.array([o[2] for o in out], pa.list_(pa.int32())), "y": pa.array([o[3] for o in out], pa.list_(pa.int32())),
            }
        )


def _excerpt(words: np.ndarray, places: Sequence[int], margin: int) -> tuple[int, np.ndarray]:
    """The words around some seeds, from which place on."""
    low = max(min(places) - margin, 0)
    return low, words[low : max(places) + SHINGLE + margin]


def _cut_out(margin: int):
    """Texts with their chains -> for each partner the seeds, largest chain first, and the words around them as 32-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(0))
            for low, high, data, offsets in chunks(texts):
                words, text = _words(data, offsets)
                short = words.astype(np.uint32)
                first = np.searchsorted(text, np.arange(high - low + 1))
                out = []
                for i in range(low, high):
                    mine = short[first[i - low] : first[i - low + 1]]
                    row, partners = batch.column(2)[i].as_py(), {}
                    for c in sorted(batch.column(1)[i].as_py(), key=lambda c: (-len(c["x"]), c["x"], c["y"])):
                        x, y = partners.setdefault(c["hub"], ([], []))
                        x += c["x"]
                        y += c["y"]
                    for hub, (x, y) in sorted(partners.items()):
                        begin, part = _excerpt(mine, x, margin)
                        out.append((hub, row, x, y, begin, begin + len(part) < len(mine), part.tobytes()))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.bool_(), pa.binary()]
                names = ["hub", "row", "x", "y", "begin", "more", "words"]
                yield pa.RecordBatch.from_pydict({n: pa.array([o[k] for o in out], t) for k, (n, t) in enumerate(zip(names, kinds, strict=True))})

    return run


def _anchors(words: np.ndarray) -> np.ndarray:
    """Hashes of ``ANCHOR`` words from each place on."""
    wide, n = words.astype(np.uint64), max(len(words) - ANCHOR + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(ANCHOR):
        out = out * np.uint64(0x9E3779B97F4A7C15) + wide[k : k + n]
    return out


class Pair:
    """Words of two texts in one direction, with the places where they differ on each diagonal that was asked for."""

    def __init__(self, a: np.ndarray, b: np.ndarray, anchors: tuple[np.ndarray, np.ndarray] | None = None):
        self.a, self.b = a, b
        self.anchors = (_anchors(a), _anchors(b)) if anchors is None else anchors
        self.differ: dict[int, list[int]] = {}

    def turned(self) -> Pair:
        """The same texts backwards."""
        return Pair(self.a[::-1], self.b[::-1], (self.anchors[0][::-1], self.anchors[1][::-1]))

    def _diagonal(self, d: int) -> list[int]:
        """Places of a, in order, whose word differs from b's, d places further; the places just before and past both are among them."""
        low, high = max(0, -d), min(len(self.a), len(self.b) - d)
        places = (np.flatnonzero(self.a[low:high] != self.b[low + d : high + d]) + low).tolist() if high > low else []
        self.differ[d] = listed = [low - 1, *places, max(high, low)]
        return listed

    def ahead(self, i: int, j: int) -> int:
        """Words from i and j on that are alike."""
        listed = self.differ.get(j - i) or self._diagonal(j - i)
        k = bisect.bisect_left(listed, i)
        return listed[k] - i if k < len(listed) else 0

    def behind(self, i: int, j: int) -> int:
        """Words before i and j that are alike."""
        listed = self.differ.get(j - i) or self._diagonal(j - i)
        k = bisect.bisect_left(listed, i) - 1
        return i - 1 - listed[k] if k >= 0 else 0


def extend(pair: Pair, i: int, j: int, runs: list[tuple[int, int, int]] | None = None) -> tuple[int, int, int, int]:
    """How far both texts go on alike from i and j: words of a, words of b, matches and edits, at the best score.

    After words that differ, the texts are put together again where ``ANCHOR`` words are alike, within ``LOOK`` words, at the
    least cost: the larger number of words skipped on a side. All runs of like words up to the drop are added to ``runs``.
    """
    best = (0, 0, 0, 0)
    top = score = matches = edits = 0
    x, y = i, j
    while True:
        run = pair.ahead(x, y)
        if run and runs is not None:
            runs.append((x, y, run))
        x, y, matches, score = x + run, y + run, matches + run, score + run
        if score > top:
            top, best = score, (x - i, y - j, matches, edits)
        p, q = pair.anchors[0][x : x + LOOK + 1], pair.anchors[1][y : y + LOOK + 1]
        u, v = (p[:, None] == q).nonzero()
        if not len(u):
            return best
        cost = np.maximum(u, v)
        k = int((cost * 64 + u + v).argmin())
        step = int(cost[k])
        if score - EDIT_COST * step < top - DROP:
            return best
        x, y, edits, score = x + int(u[k]), y + int(v[k]), edits + step, score - EDIT_COST * step


def _between(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of like words of the best alignment of all of a with all of b."""
    m, n = len(a), len(b)
    if not m or not n or m == n == 1 or max(m, n) > WIDEST:
        return []
    ramp = EDIT_COST * np.arange(n + 1)
    table = np.empty((m + 1, n + 1), np.int64)
    table[0] = ramp
    for i in range(m):
        before, row = table[i], table[i + 1]
        row[0] = before[0] + EDIT_COST
        np.minimum(before[1:] + EDIT_COST, before[:-1] + np.where(b == a[i], -1, EDIT_COST), out=row[1:])
        row -= ramp
        np.minimum.accumulate(row, out=row)
        row += ramp
    cost, out, i, j = table.tolist(), [], m, n
    while i and j:
        if a[i - 1] == b[j - 1] and cost[i][j] == cost[i - 1][j - 1] - 1:
            i, j = i - 1, j - 1
            out.append((i, j, 1))
        elif cost[i][j] == cost[i - 1][j - 1] + EDIT_COST:
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + EDIT_COST:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _path(pair: Pair, turned: Pair, seeds: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Runs of like words (begin in a, begin in b, words) of one chain: outwards from its ends, and gaps between its seeds aligned."""
    a, b = pair.a, pair.b
    runs: list[tuple[int, int, int]] = []
    i, j = seeds[0]
    extend(turned, len(a) - i, len(b) - j, runs)
    found = [(len(a) - x - n, len(b) - y - n, n) for x, y, n in reversed(runs)]
    x, y = i, j
    for i, j in seeds:
        over = max(x - i, y - j, 0)
        if over >= SHINGLE or not (run := pair.ahead(i + over, j + over)):
            continue
        i, j = i + over, j + over
        back = min(pair.behind(i, j), i - x, j - y)
        found += [(x + u, y + v, n) for u, v, n in _between(a[x : i - back], b[y : j - back])]
        found.append((i - back, j - back, run + back))
        x, y = i + run, j + run
    runs = []
    extend(pair, x, y, runs)
    joined: list[tuple[int, int, int]] = []
    for i, j, n in found + runs:
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            joined[-1] = (*joined[-1][:2], joined[-1][2] + n)
        else:
            joined.append((i, j, n))
    return joined


def _stretches(runs: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """The longest stretch of ``MIN_WORDS`` words and ``MIN_SIMILARITY``, and those before and after it, as passages.

    Its ends are cut off as far as they are less than half alike, if ``MIN_WORDS`` words are left.
    """
    if not runs or min(runs[-1][k] + runs[-1][2] - runs[0][k] for k in (0, 1)) < MIN_WORDS:
        return
    # Up to the begin and the end of each run: matches and edits.
    matches, edits, ends = [0], [0], []
    for before, (x, y, n) in zip([None, *runs], runs, strict=False):
        if before:
            edits.append(edits[-1] + max(x - before[0] - before[2], y - before[1] - before[2]))
        matches.append(matches[-1] + n)
        ends.append(matches[-1])
    low = [(1 - MIN_SIMILARITY) * m - MIN_SIMILARITY * e for m, e in zip(matches, edits, strict=False)]
    high = [(1 - MIN_SIMILARITY) * m - MIN_SIMILARITY * e for m, e in zip(ends, edits, strict=True)]
    starts: list[int] = []
    for k, v in enumerate(low):
        if not starts or v < low[starts[-1]]:
            starts.append(k)
    best = (-1, 0, 0)
    for e in range(len(runs) - 1, -1, -1):
        while starts and high[e] - low[starts[-1]] >= -1e-9:
            s = starts.pop()
            if s <= e:
                best = max(best, (ends[e] + edits[e] - matches[s] - edits[s], s, e))
        if not starts:
            break
    _, s, e = best

    def told(s: int, e: int) -> tuple[int, int, int, int, int, int]:
        (x, y, _), (u, v, n) = runs[s], runs[e]
        return x, u + n, y, v + n, ends[e] - matches[s], edits[e] - edits[s]

    end = max(range(s, e + 1), key=lambda k: (ends[k] - edits[k], k))
    begin = min(range(s, end + 1), key=lambda k: (matches[k] - edits[k], k))
    long = lambda p: min(p[1] - p[0], p[3] - p[2]) >= MIN_WORDS
    if long(told(begin, end)):
        s, e = begin, end
    if long(told(s, e)):
        yield told(s, e)
    yield from _stretches(runs[:s])
    yield from _stretches(runs[e + 1 :])


def passages(
    a: np.ndarray, b: np.ndarray, x: Sequence[int], y: Sequence[int], inside: tuple[int, int, int, int] | None = None, cut: list[bool] | None = None
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(begin, end in a, begin, end in b, matches, edits) of the passages along chains of seeds at x in a and y in b.

    Seeds come chain by chain; a chain ends where x or y doesn't grow. Seeds in a passage or a run of like words that an earlier chain gave
    are left out, so periodic texts are not aligned again and again. ``inside`` says from and up to where a path may
    go in a and in b; one that goes beyond is told in ``cut``.
    """
    taken = bytearray(len(a))
    pair = Pair(a, b)
    turned = pair.turned()
    parts: list[list[tuple[int, int]]] = []
    for i, j in zip(x, y, strict=True):
        if not parts or i <= parts[-1][-1][0] or j <= parts[-1][-1][1]:
            parts.append([])
        parts[-1].append((i, j))
    for part in parts:
        seeds = [(i, j) for i, j in part if not taken[i] and pair.ahead(i, j) >= SHINGLE]
        if not seeds:
            continue
        runs = _path(pair, turned, seeds)
        if runs and inside is not None:
            (i, j, _), (u, v, n) = runs[0], runs[-1]
            if i < inside[0] or j < inside[1] or u + n > inside[2] or v + n > inside[3]:
                cut.append(True)
        for i, _, n in runs:
            taken[i : i + n] = b"\1" * n
        for p in _stretches(runs):
            taken[p[0] : p[1]] = b"\1" * (p[1] - p[0])
            yield p


def _align(margin: int):
    """(hub's text, hub, row, x, y, begin, more, words) -> passages; for a pair whose alignment comes near a cut only that, with ``open``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(0))
            hub, row = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            xs, ys, begins, mores, excerpts = (batch.column(k) for k in range(3, 8))
            out, last, words = [], None, np.zeros(0, np.uint32)
            for i in range(batch.num_rows):
                if hub[i] != last:
                    text = np.frombuffer(texts[i].as_buffer().to_pybytes(), np.uint8)
                    words, last = _words(text, np.array([0, len(text)]))[0].astype(np.uint32), hub[i]
                x, y, begin = xs[i].as_py(), ys[i].as_py(), begins[i].as_py()
                a = np.frombuffer(excerpts[i].as_py(), np.uint32)
                low, b = _excerpt(words, y, margin)
                near = LOOK + ANCHOR
                inside = (
                    near if begin else 0, near if low else 0,
                    len(a) - near if mores[i].as_py() else len(a), len(b) - near if low + len(b) < len(words) else len(b),
                )
                cut: list[bool] = []
                found = list(passages(a, b, [k - begin for k in x], [k - low for k in y], inside, cut))
                if cut:
                    out.append((row[i], hub[i], *[None] * 6, True))
                    continue
                for p in found:
                    out.append((row[i], hub[i], p[0] + begin, p[1] + begin, p[2] + low, p[3] + low, p[4], p[4] / (p[4] + p[5]), False))
            names = ["row", "hub", "begin_word", "end_word", "other_begin", "other_end", "matches", "similarity", "open"]
            kinds = [pa.int64(), pa.int64(), *[pa.int64()] * 5, pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_pydict({n: pa.array([o[k] for o in out], t) for k, (n, t) in enumerate(zip(names, kinds, strict=True))})

    return run


FOUND = "row long, hub long, begin_word long, end_word long, other_begin long, other_end long, matches long, similarity double, open boolean"


def matched_chains(texts: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``row, text`` -> ``row, hub, x, y``: the chains of all pairs that may share a passage."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))

    def dealt(blocks: DataFrame) -> DataFrame:
        return blocks.repartition(parts, "part").sortWithinPartitions("part")

    seeds = dealt(texts.mapInArrow(_scan(parts), BLOCKS))
    contexts = dealt(seeds.mapInArrow(_meet(parts), BLOCKS))
    return dealt(contexts.mapInArrow(_meet_again(parts), BLOCKS)).mapInArrow(_chain, CHAINS)


def shared_passages(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, begin_word, end_word, other_id, other_begin, other_end, matches, similarity``: one row per passage and partner.

    Partners are representatives of what is shared: a passage in many documents gives each of them a row with an earlier one, not with all.
    """
    ship_package(docs.sparkSession)
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    plain = has_plain_ids(slim)
    if plain:
        texts = slim.select(F.col("doc_id").alias("row"), "text")
    else:
        numbered = spill(slim.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
        texts = numbered.select("row", "text")
    texts = texts.filter("row IS NOT NULL")

    todo, margin, rounds = spill(matched_chains(texts, part_bytes)), MARGIN, []
    while True:
        release(docs.sparkSession)  # the seeds' blocks, or the texts of the round before
        asked = todo.groupBy("row").agg(F.collect_list(F.struct("hub", "row", "x", "y")).alias("chains"))
        cut = texts.join(asked, "row").select("text", "chains", "row").mapInArrow(_cut_out(margin), "hub long, row long, x array<int>, y array<int>, begin int, more boolean, words binary")
        sides = texts.join(cut.withColumnRenamed("row", "other").withColumnRenamed("hub", "row"), "row")
        sides = sides.select("text", F.col("row").alias("hub"), F.col("other").alias("row"), "x", "y", "begin", "more", "words")
        told = spill(sides.mapInArrow(_align(margin), FOUND))
        rounds.append(told.filter("NOT open").drop("open"))
        again = told.filter("open").select("row", "hub")
        if again.isEmpty():
            break
        todo, margin = spill(todo.join(again, ["row", "hub"], "left_semi")), margin * GROWTH
    found = rounds[0]
    for more in rounds[1:]:
        found = found.unionByName(more)
    if plain:
        return found.select(F.col("row").alias("doc_id"), "begin_word", "end_word", F.col("hub").alias("other_id"), "other_begin", "other_end", "matches", "similarity")
    ids = numbered.select("row", "doc_id")
    named = found.join(ids, "row").join(ids.select(F.col("row").alias("hub"), F.col("doc_id").alias("other_id")), "hub")
    return named.select("doc_id", "begin_word", "end_word", "other_id", "other_begin", "other_end", "matches", "similarity")
