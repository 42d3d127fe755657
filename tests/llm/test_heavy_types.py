"""Types with many customers in the Pitman-Yor sweeps."""

from array import array

import numpy as np

from trailmark.llm import pitman_yor as P


def sweep(counts, tables, sizes, rng):
    n = len(counts)
    totals = P.Totals(1000, 10, 5, n, 100, 50)
    return P._moved(np.array(counts), np.array(tables), np.array(sizes), np.arange(n), np.full(n, 0.1), np.full(n, 5), totals, rng)


def test_a_sweep_moves_as_many_customers_as_a_type_has():
    rng = np.random.default_rng(1)
    for n in (1, P.TOGETHER):  # one after the other, and side by side
        counts = [3000] * n
        tables, sizes = sweep(counts, counts, [1] * 3000 * n, rng)
        assert (tables < 0.6 * 3000).all() and sizes.sum() == 3000 * n and len(sizes) == tables.sum() and (sizes > 0).all()


def test_one_after_the_other_has_the_exact_distribution():
    rng, c, pull, discount = np.random.default_rng(2), 40, 3.0, 0.6
    ways = np.zeros(c + 2)  # of seating c customers at t tables, by their weights
    ways[1] = 1
    for n in range(1, c):
        ways = np.concatenate([[0], ways[:-1]]) + (n - discount * np.arange(c + 2)) * ways
    share = np.clip(ways, 0, None) * pull ** np.arange(c + 2)
    seen, own = [], [c]
    for _ in range(8000):
        t, own = P._reseated(array("i", np.repeat(np.arange(len(own)), own).astype(np.int32).tobytes()), list(own), lambda t: pull, discount, rng)
        assert t == len(own) and sum(own) == c and min(own) > 0
        seen.append(t)
    assert abs(np.mean(seen[100:]) - np.average(np.arange(c + 2), weights=share)) < 0.2 * np.std(seen)
