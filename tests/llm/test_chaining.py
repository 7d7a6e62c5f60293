"""Collinear chaining against a quadratic loop."""

import random

import pytest

from strandmill.llm.chaining import PrefixMax, chains


def best_score(matches, reward, gap):
    order = sorted(range(len(matches)), key=lambda i: matches[i])
    score = {}
    for i in order:
        x, y = matches[i]
        score[i] = reward + max([0.0, *(score[j] - gap * (x - matches[j][0] + y - matches[j][1]) for j in score if matches[j][0] < x and matches[j][1] < y)])
    return max(score.values(), default=0)


def score_of(chain, matches, reward, gap):
    points = [matches[i] for i in chain]
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(points, points[1:]))
    return reward * len(points) - gap * (points[-1][0] - points[0][0] + points[-1][1] - points[0][1])


@pytest.mark.parametrize("seed", range(20))
def test_first_chain_is_the_best(seed):
    rng = random.Random(seed)
    matches = list({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.randint(0, 60))})
    found = chains(matches, 5, 0.2)
    assert sorted(i for c in found for i in c) == list(range(len(matches)))
    for c in found:
        score_of(c, matches, 5, 0.2)
    if matches:
        assert score_of(found[0], matches, 5, 0.2) == pytest.approx(best_score(matches, 5, 0.2))


def test_prefix_max():
    rng = random.Random(1)
    tree, values = PrefixMax(30), []
    for i in range(200):
        place, value = rng.randrange(30), rng.random()
        tree.put(place, value, i)
        values.append((place, value, i))
        bound = rng.randrange(31)
        below = [(v, k) for p, v, k in values if p < bound]
        assert tree.below(bound) == max(below, default=(float("-inf"), -1))
