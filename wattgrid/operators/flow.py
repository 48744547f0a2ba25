"""Exact min-cost assignment of appliance-hours under a per-hour cap.

A transportation problem (appliance i needs ``need[i]`` distinct hours from
its allowed set, each hour takes at most ``cap`` appliances), solved on the
hours alone: moving one appliance from an hour to another is an arc whose cost
is the least price difference any appliance offers.  Costs are 64-bit.
"""

from __future__ import annotations

import numpy as np

FAR = np.int64(1) << 60


def _steps(on: np.ndarray, allowed: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Per pair of hours the least cost of moving an appliance from the first
    to the second (``FAR``: none can)."""
    leave = np.where(on, -cost, FAR)
    enter = np.where(allowed & ~on, cost, FAR)
    least = (leave[:, :, None] + enter[:, None, :]).min(axis=0)
    return np.where(least >= FAR // 2, FAR, least)


def _move(on: np.ndarray, allowed: np.ndarray, cost: np.ndarray, path: list[int]) -> None:
    """Moves one appliance-hour along a path of hours, each step by the
    appliance that does it at the least cost."""
    moved = []
    for a, b in zip(path, path[1:]):
        can = on[:, a] & allowed[:, b] & ~on[:, b]
        moved.append((int(np.where(can, cost[:, b] - cost[:, a], FAR).argmin()), a, b))
    for i, a, b in moved:
        on[i, a], on[i, b] = False, True


def _shortest(step: np.ndarray, sources: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances from the sources and the hour before each (Bellman-Ford)."""
    dist = np.where(sources, 0, FAR)
    before = np.full(len(dist), -1)
    for _ in range(len(dist)):
        through = np.where((dist[:, None] < FAR) & (step < FAR), dist[:, None] + step, FAR)
        best = through.argmin(axis=0)
        value = through[best, np.arange(len(dist))]
        better = value < dist
        if not better.any():
            break
        dist, before = np.where(better, value, dist), np.where(better, best, before)
    return dist, before


def _path(before: np.ndarray, end: int) -> list[int]:
    out = [int(end)]
    while before[out[-1]] >= 0:
        out.append(int(before[out[-1]]))
    return out[::-1]


def min_cost_assignment(needs: list[int], cells: list[tuple[int, int, int]], cap: int,
                        hours: int = 24) -> list[tuple[int, int]] | None:
    """The pairs that :func:`assignment_with_prices` chooses."""
    solved = assignment_with_prices(needs, cells, cap, hours)
    return None if solved is None else solved[0]


def assignment_with_prices(needs: list[int], cells: list[tuple[int, int, int]], cap: int,
                           hours: int = 24) -> tuple[list[tuple[int, int]], list[int]] | None:
    """``cells`` = (appliance index, hour, cost).  Returns the chosen
    (appliance, hour) pairs and the price of each hour, or None if the demand
    cannot be met.

    Every appliance starts on its cheapest hours; as long as an hour is over
    the cap, one appliance-hour moves on along the cheapest path to an hour
    with room (successive shortest paths, so the cost stays least).  Among
    equal costs the canonical schedule is the one whose (appliance, hour)
    cells, read as a binary number with ``appliance * hours + hour`` as the bit,
    are the smallest: from the highest cell down, each that is on is turned off
    if a move of no cost that leaves the cells above alone allows it."""
    n = len(needs)
    cost = np.zeros((n, hours), np.int64)
    allowed = np.zeros((n, hours), bool)
    for i, h, c in cells:
        cost[i, h], allowed[i, h] = c, True
    on = np.zeros((n, hours), bool)
    for i, need in enumerate(needs):
        order = sorted(np.flatnonzero(allowed[i]).tolist(), key=lambda h: (cost[i, h], h))
        if len(order) < need:
            return None
        on[i, order[:need]] = True
    while True:
        load = on.sum(axis=0)
        if (load <= cap).all():
            break
        dist, before = _shortest(_steps(on, allowed, cost), load > cap)
        room = np.where(load < cap, dist, FAR)
        end = int(room.argmin())
        if room[end] >= FAR:
            return None
        _move(on, allowed, cost, _path(before, end))
    price = _distances(on, allowed, cost, cap)
    _make_canonical(on, allowed, cost, cap, price)
    # What a place in a full hour is worth; 0 where there is room.
    worth = np.maximum(price[hours] - price[:hours], 0)
    return [(int(i), int(h)) for i, h in zip(*np.nonzero(on))], worth.tolist()


def _distances(on: np.ndarray, allowed: np.ndarray, cost: np.ndarray, cap: int) -> np.ndarray:
    """Shortest distances over all moves of a least-cost schedule, and over an
    extra node (the last) that joins hours with room and hours with load."""
    hours = on.shape[1]
    step = np.full((hours + 1, hours + 1), FAR)
    step[:hours, :hours] = _steps(on, allowed, cost)
    load = on.sum(axis=0)
    step[:hours, hours] = np.where(load < cap, 0, FAR)
    step[hours, :hours] = np.where(load > 0, 0, FAR)
    return _shortest(step, np.ones(hours + 1, bool))[0]


def _make_canonical(on: np.ndarray, allowed: np.ndarray, cost: np.ndarray, cap: int, price: np.ndarray) -> None:
    """Turns a least-cost schedule into the canonical one.

    The distances say which cells any other least-cost schedule may change:
    those whose cost less their hour's distance is the appliance's margin.  Only
    these take part, and a move among them costs nothing, so each cell needs a
    search over 24 hours only."""
    n, hours = on.shape
    free = price[:hours] == price[hours]
    net = cost - price[:hours]
    margin = np.where(on, net, -FAR).max(axis=1, keepdims=True)
    live = allowed & (net == margin)
    live &= (live & on).any(axis=1, keepdims=True) & (live & ~on).any(axis=1, keepdims=True)
    for i in range(n - 1, -1, -1):
        for h in range(hours - 1, -1, -1):
            if not live[i, h]:
                continue
            live[i, h] = False
            if not on[i, h] or not (live[i] & ~on[i]).any():
                continue
            open_on, open_off = live & on, live & ~on
            arcs = (open_on.T.astype(np.float32) @ open_off.astype(np.float32)) > 0
            # From the hours the appliance can go to instead, until the hour it
            # leaves, or an hour with room if the left one may stay emptier.
            seen, before, ends = open_off[i].copy(), np.full(hours, -1), None
            goal = ((on.sum(axis=0) < cap) & free) if free[h] else np.zeros(hours, bool)
            goal[h] = True
            front = np.flatnonzero(seen)
            while len(front):
                done = front[goal[front]]
                if len(done):
                    ends = int(done[0])
                    break
                reach = arcs[front] & ~seen
                to = np.flatnonzero(reach.any(axis=0))
                before[to] = front[reach[:, to].argmax(axis=0)]
                seen[to] = True
                front = to
            if ends is None:
                continue
            path = _path(before, ends)
            moved = [(int((open_on[:, a] & open_off[:, b]).argmax()), a, b) for a, b in zip(path, path[1:])]
            on[i, h], on[i, path[0]] = False, True
            for j, a, b in moved:
                on[j, a], on[j, b] = False, True
