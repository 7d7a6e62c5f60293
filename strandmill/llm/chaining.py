"""Collinear chaining of matches with a Fenwick tree."""

from __future__ import annotations

from collections.abc import Sequence


class PrefixMax:
    """Fenwick tree of (value, item): the largest value at places below a bound."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def put(self, place: int, value: float, item: int) -> None:
        entry, i = (value, item), place + 1
        while i < len(self.best):
            if entry > self.best[i]:
                self.best[i] = entry
            i += i & -i

    def below(self, place: int) -> tuple[float, int]:
        found, i = (float("-inf"), -1), place
        while i > 0:
            if self.best[i] > found:
                found = self.best[i]
            i -= i & -i
        return found


def chains(matches: Sequence[tuple[int, int]], reward: float, gap: float) -> list[list[int]]:
    """Chains of matches (x, y), as indexes, best first; each match is in one chain.

    In a chain x and y both grow. A match earns ``reward`` and pays ``gap`` for each step of x and of y from the one
    before; a match that no chain so far is worth joining starts its own. With f the best score of a chain up to a match,
    f + gap * (x + y) compares all predecessors at once, so a prefix maximum over y is all that is needed.
    """
    order = sorted(range(len(matches)), key=lambda i: matches[i])
    rank = {y: r for r, y in enumerate(sorted({y for _, y in matches}))}
    tree = PrefixMax(len(rank))
    score, back = [0.0] * len(matches), [-1] * len(matches)
    at = 0
    while at < len(order):
        end = at
        while end < len(order) and matches[order[end]][0] == matches[order[at]][0]:
            end += 1
        for i in order[at:end]:  # matches of one x can't follow each other
            x, y = matches[i]
            value, before = tree.below(rank[y])
            score[i] = reward
            if before >= 0 and (joined := value - gap * (x + y)) > 0:
                score[i] += joined
                back[i] = before
        for i in order[at:end]:
            x, y = matches[i]
            tree.put(rank[y], score[i] + gap * (x + y), i)
        at = end
    used = [False] * len(matches)
    out = []
    for i in sorted(range(len(matches)), key=lambda i: (-score[i], matches[i])):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out
