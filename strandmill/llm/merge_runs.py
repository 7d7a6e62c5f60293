"""Front-coded sorted runs and a loser tree that never compares a known common prefix again."""

from __future__ import annotations

import marshal
from collections.abc import Iterator, Sequence


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix; the first ``known`` bytes are known to be equal."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(rows: Sequence[tuple]) -> bytes:
    """Rows (suffix, left context, *rest), sorted by suffix: of both texts only what differs from the row before."""
    lcps, tails, left_lcps, left_tails, rest = [], [], [], [], []
    before, left_before = b"", b""
    for suffix, left, *more in rows:
        n, m = common(before, suffix), common(left_before, left)
        lcps.append(n)
        tails.append(suffix[n:])
        left_lcps.append(m)
        left_tails.append(left[m:])
        rest.append(tuple(more))
        before, left_before = suffix, left
    return marshal.dumps((lcps, tails, left_lcps, left_tails, rest))


def read_run(block: bytes) -> Iterator[tuple[int, bytes, tuple]]:
    """(common prefix with the row before, suffix, (left context, *rest)) of a run, decoded as it is read."""
    before, left_before = b"", b""
    for n, tail, m, left_tail, rest in zip(*marshal.loads(block), strict=True):
        before, left_before = before[:n] + tail, left_before[:m] + left_tail
        yield n, before, (left_before, *rest)


def merge(runs: Sequence[Iterator[tuple[int, bytes, tuple]]]) -> Iterator[tuple[int, bytes, tuple]]:
    """All rows in order, with the common prefix of each with the row before it.

    Every loser in the tree knows its common prefix with the winner it lost to. When a winner leaves, its run's next row
    knows its common prefix with the winner from the front coding, and on its way up it meets only losers to that
    same winner: the longer known prefix wins, and only at equal lengths are the bytes behind it compared.
    """
    k = 1
    while k < len(runs):
        k *= 2
    done = None
    heads: list[tuple[bytes, tuple] | None] = [done] * k
    loser = [0] * k  # of inner node i (1 to k - 1): a run
    loser_lcp = [0] * k

    def pull(r: int) -> int:
        row = next(runs[r], None) if r < len(runs) else None
        heads[r] = None if row is None else (row[1], row[2])
        return 0 if row is None else row[0]

    def play(r: int, r_lcp: int, s: int, s_lcp: int) -> tuple[int, int, int, int]:
        """Winner, its known prefix with the last row out, loser, the loser's common prefix with the winner."""
        if heads[s] is None:
            return r, r_lcp, s, 0
        if heads[r] is None:
            return s, s_lcp, r, 0
        if r_lcp != s_lcp:
            return (r, r_lcp, s, s_lcp) if r_lcp > s_lcp else (s, s_lcp, r, r_lcp)
        a, b = heads[r][0], heads[s][0]
        n = common(a, b, r_lcp)
        if a[n : n + 1] <= b[n : n + 1]:
            return r, r_lcp, s, n
        return s, s_lcp, r, n

    for r in range(k):
        pull(r)
    up = [(r, 0) for r in range(k)]
    level = k
    while level > 1:
        level //= 2
        nxt = []
        for i in range(level):
            (r, x), (s, y) = up[2 * i], up[2 * i + 1]
            w, w_lcp, lost, lost_lcp = play(r, x, s, y)
            loser[level + i], loser_lcp[level + i] = lost, lost_lcp
            nxt.append((w, w_lcp))
        up = nxt
    winner, lcp = up[0]
    while (head := heads[winner]) is not None:
        yield lcp, head[0], head[1]
        r, lcp = winner, pull(winner)
        node = (k + r) // 2
        while node:
            r, lcp, loser[node], loser_lcp[node] = play(r, lcp, loser[node], loser_lcp[node])
            node //= 2
        winner = r
