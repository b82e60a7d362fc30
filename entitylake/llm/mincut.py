"""Two-way labelling of a small graph by its minimum cut."""

from __future__ import annotations


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling with the least cost: who stays on the source's side.

    ``gain[i] > 0`` is what it costs to put ``i`` on the sink's side, ``gain[i] < 0`` what it costs
    to leave it on the source's: the capacities to the two terminals. An edge ``(i, j, c)`` costs
    ``c`` if its ends are parted. The maximum flow saturates the cheapest cut; flow goes along
    shortest paths, level by level. Of equally cheap cuts, the one with the fewest on the source's side.
    """
    n = len(gain)
    near: list[list[int]] = [[] for _ in range(n)]
    head: list[int] = []
    room: list[float] = []
    for i, j, capacity in edges:
        near[i].append(len(head))
        near[j].append(len(head) + 1)
        head += [j, i]
        room += [capacity, capacity]
    left = list(gain)  # what is left of the terminal capacities
    tiny = 1e-9
    while True:
        level = [-1] * n
        front = [i for i in range(n) if left[i] > tiny]
        for i in front:
            level[i] = 0
        reached, depth = False, 0
        while front and not reached:
            depth += 1
            following = []
            for i in front:
                for e in near[i]:
                    j = head[e]
                    if room[e] > tiny and level[j] < 0:
                        level[j] = depth
                        following.append(j)
                        reached = reached or left[j] < -tiny
            front = following
        if not reached:
            return [found >= 0 for found in level]
        at = [0] * n
        for source in range(n):
            while left[source] > tiny and level[source] == 0:
                path: list[int] = []
                i = source
                while left[i] >= -tiny:
                    while at[i] < len(near[i]):
                        e = near[i][at[i]]
                        if room[e] > tiny and level[head[e]] == level[i] + 1:
                            break
                        at[i] += 1
                    else:  # a dead end: one step back, and not here again
                        level[i] = -2 if path else level[i]
                        if not path:
                            break
                        i = head[path.pop() ^ 1]
                        at[i] += 1
                        continue
                    path.append(e)
                    i = head[e]
                if left[i] >= -tiny:
                    break
                flow = min(left[source], -left[i], *(room[e] for e in path))
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                left[source] -= flow
                left[i] += flow
