"""Cutting stock by column generation, over a histogram of item sizes; no documents here."""

from __future__ import annotations

import numpy as np

#: Pivots of the linear program at most; what is then left to gain costs padding, never items.
PIVOTS = 6_000
#: Sequences that one more cut may cost.
CUT_COST = 0.004


def price(duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The knapsack of the pricing step: the most valuable multiset of sizes that fits.

    ``duals[s]`` is the value of an item of size s (0 or less: not used).
    """
    value = np.where(duals > 0, duals, -1.0)
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        with_item = value[1:c + 1] + best[c - 1::-1] if c > 1 else value[1:2] + best[:1]
        s = int(np.argmax(with_item))
        if with_item[s] > best[c - 1] + 1e-12:
            best[c], take[c] = with_item[s], s + 1
        else:
            best[c] = best[c - 1]
    column, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if take[c]:
            column[take[c]] += 1
            c -= take[c]
        else:
            c -= 1
    return float(best[capacity]), column


def solve(counts: np.ndarray, capacity: int, pivots: int = PIVOTS) -> list[tuple[np.ndarray, float]]:
    """Columns and how often each is used in the linear program's solution.

    ``counts[s]`` items of size s, 0 < s <= capacity. A pattern holds the number of items of
    each size; their sizes sum to the capacity at most. A cut takes one item of a size over half
    of the capacity and gives an item of half of it (-1) and one of the rest (-1), at ``CUT_COST``.
    """
    half = capacity // 2
    sizes = np.flatnonzero(counts)
    larger = sizes[sizes > half]
    if len(larger):
        sizes = np.union1d(sizes, np.append(larger - half, half))
    m = len(sizes)
    if m == 0:
        return []
    fits = capacity // sizes
    columns = [np.eye(1, capacity + 1, s, dtype=np.int64)[0] * f for s, f in zip(sizes, fits)]
    inverse, amount, cost = np.diag(1.0 / fits), counts[sizes] / fits, np.ones(m)
    for _ in range(pivots):
        duals = np.zeros(capacity + 1)
        duals[sizes] = cost @ inverse
        value, column = price(duals, capacity)
        gain, entering = value - 1, 1.0
        if len(larger):
            by_cut = duals[larger] - duals[larger - half] - duals[half] - CUT_COST
            if by_cut.max() > gain:
                s = larger[int(np.argmax(by_cut))]
                gain, entering, column = by_cut.max(), CUT_COST, np.zeros(capacity + 1, np.int64)
                column[[s, s - half, half]] = 1, -1, -1
        if gain <= 1e-6:
            break
        change = inverse @ column[sizes]
        up = change > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = amount[up] / change[up]
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        step = max(ratio[out], 0.0)
        amount -= step * change
        amount[out] = step
        np.maximum(amount, 0, out=amount)
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        columns[out], cost[out] = column, entering
    return list(zip(columns, amount))


def rounded(counts: np.ndarray, capacity: int, pivots: int = PIVOTS) -> tuple[np.ndarray, list[tuple[np.ndarray, int]], np.ndarray]:
    """Items of each size to cut, patterns used a whole number of times, and the items that this leaves."""
    half, left, cuts, used = capacity // 2, counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64), []
    solution = solve(counts, capacity, pivots)
    for column, amount in solution:
        if column.min() < 0:
            s = int(np.flatnonzero(column > 0)[0])
            cuts[s] = min(int(amount + 1e-6), int(counts[s]))
            left[[s, s - half]] += -cuts[s], cuts[s]
            left[half] += cuts[s]
    for column, amount in solution:
        held = column > 0
        times = min(int(amount + 1e-6), int((left[held] // column[held]).min()))
        if column.min() >= 0 and times > 0:
            used.append((column, times))
            left -= times * column
    return cuts, used, left
