"""Checkers of the defining properties of the k-center results, over a full
distance matrix. Distances are summed left to right from 0.0 before the square
root, so comparisons at radii are exact."""

import numpy as np


def distance_matrix(a, b=None):
    a = np.asarray(a, float)
    b = a if b is None else np.asarray(b, float)
    total = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        total += (a[:, k, None] - b[None, :, k]) ** 2
    return np.sqrt(total)


def dist(a, b):
    return float(distance_matrix([a], [b])[0, 0])


def check_traversal(points, order, n_centers):
    """``order``: positions. Starts at 0; every pick is the point farthest from the
    earlier ones (lowest position on ties); it ends early only at distance 0."""
    gap = distance_matrix(points)
    assert order[0] == 0 and len(order) <= n_centers
    for step in range(1, len(order) + 1):
        reach = gap[:, order[:step]].min(axis=1)
        if step < len(order):
            assert order[step] == reach.argmax() and reach.max() > 0
        else:
            assert step == n_centers or reach.max() == 0


def check_coreset(points, rows, n_centers, parts):
    """``rows``: (part_id, step, point_id, weight) over points whose id is their position."""
    for part in range(parts):
        ids = np.arange(part, len(points), parts)
        own = sorted((s, i, w) for p, s, i, w in rows if p == part)
        if not len(ids):
            assert not own
            continue
        mine = np.asarray(points, float)[ids]
        order = [int(np.flatnonzero(ids == i)[0]) for _, i, _ in own]
        assert [s for s, _, _ in own] == list(range(len(own)))
        check_traversal(mine, order, n_centers)
        nearest = distance_matrix(mine)[:, order].argmin(axis=1)  # the earliest center on ties
        assert [w for _, _, w in own] == np.bincount(nearest, minlength=len(order)).tolist()
    assert {p for p, *_ in rows} <= set(range(parts))


class Cover:
    """The state of a greedy cover at one radius."""

    def __init__(self, gap, weights, r, alpha):
        self.ball, self.removed = gap <= (1 + 2 * alpha) * r, gap <= (3 + 4 * alpha) * r
        self.weights, self.open = np.asarray(weights), np.ones(len(gap), bool)

    def heaviest(self):
        """Lowest position with the most uncovered weight in its ball; None if there is none."""
        held = self.ball @ (self.weights * self.open)
        return int(held.argmax()) if held.max() > 0 else None

    def take(self, pick):
        self.open &= ~self.removed[pick]

    def left(self):
        return int(self.weights[self.open].sum())


def check_cover(points, weights, picks, left, k, r, alpha):
    state = Cover(distance_matrix(points), weights, r, alpha)
    for pick in picks:
        assert pick == state.heaviest()
        state.take(pick)
    assert len(picks) == k or state.heaviest() is None
    assert left == state.left()


def check_solution(points, weights, picks, r0, r, guesses, k, z, alpha):
    """The picks are the greedy cover at r, r is feasible, and no smaller guess is."""
    gap = distance_matrix(points)
    head = gap[:k + z + 1, :k + z + 1]
    some = head[head > 0] if (head > 0).any() else gap[gap > 0]
    assert r0 == (np.inf if len(points) == 1 else some.min() / 2 if len(some) else 0.0)
    assert r == r0 * 2.0 ** (guesses - 1)

    def left_at(radius):
        state = Cover(gap, weights, radius, alpha)
        for _ in range(k):
            if (pick := state.heaviest()) is None:
                break
            state.take(pick)
        return state.left()

    check_cover(points, weights, picks, left_at(r), k, r, alpha)
    assert left_at(r) <= z
    assert all(left_at(r0 * 2.0 ** g) > z for g in range(guesses - 1))
