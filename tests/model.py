"""A point-set model of interval algebra: slow, obvious, and independent of the library."""

import random


def points(intervals):
    return {p for a, b in intervals for p in range(a, b)}


def spans(pts):
    out = []
    for p in sorted(pts):
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [tuple(x) for x in out]


def random_set(rng: random.Random, n: int, axis: int, longest: int):
    out = []
    for _ in range(n):
        a = rng.randrange(0, axis)
        out.append((a, a + rng.randrange(0, longest + 1)))
    return out
