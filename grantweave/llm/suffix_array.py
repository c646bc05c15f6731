"""Suffix order in linear grouping steps: Lyndon-prefix groups first, then each group's order.

Groups hold the suffixes that begin with the same Lyndon word. They start as one group for each
symbol and are taken from the highest to the lowest. A suffix points to the nearest place before it
in a lower group (its previous-smaller pointer); the places pointed to go on with the word of the
group at hand, so they leave their group for new ones right behind it, by how many pointers they
got. In the end one pass from the smallest suffix on places every suffix into the next free slot of
its group. Nothing is renamed and no recursion is needed.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Start places of all suffixes in order. The last symbol must be the only smallest one."""
    n = len(text)
    if n < 2:
        return list(range(n))
    group, previous, size = _lyndon_groups(text)
    order, placed, free = [-1] * n, bytearray(n), list(range(n))
    order[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        at = order[i] - 1
        while at >= 0 and not placed[at]:
            g = group[at]
            order[free[g]] = at
            free[g] += 1
            placed[at] = 1
            at = previous[at]
    return order


def _lyndon_groups(text: list[int]) -> tuple[list[int], list[int], list[int]]:
    """For each place the first slot of its group, and its previous-smaller pointer; the groups' sizes."""
    n = len(text)
    slots = sorted(range(n), key=text.__getitem__)
    slot_of, group, size = [0] * n, [0] * n, [0] * n
    first, symbol = 0, None
    for slot, at in enumerate(slots):
        slot_of[at] = slot
        if text[at] != symbol:
            first, symbol = slot, text[at]
        group[at] = first
        size[first] += 1
    previous = [-1] * n

    def leave(at: int) -> None:
        """Swaps a place to the last slot of what is left of its group."""
        g = group[at]
        size[g] -= 1
        last, own = g + size[g], slot_of[at]
        other = slots[last]
        slots[own], slots[last] = other, at
        slot_of[other], slot_of[at] = own, last

    end = n
    while end > 0:
        start = group[slots[end - 1]]
        if end - start == 1:
            at = slots[start]
            p = at - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[at] = p
            if p >= 0 and size[group[p]] > 1:
                leave(p)
                group[p] = slot_of[p]
                size[slot_of[p]] = 1
        else:
            pointed: dict[int, int] = {}
            for at in sorted(slots[start:end]):
                p = at - 1
                while p >= 0 and group[p] >= start:
                    p = previous[p]
                previous[at] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, count in pointed.items():
                by_count.setdefault(count, []).append(p)
            for count in sorted(by_count, reverse=True):
                by_group: dict[int, list[int]] = {}
                for p in by_count[count]:
                    by_group.setdefault(group[p], []).append(p)
                for g, moved in by_group.items():
                    if size[g] == len(moved):
                        continue
                    for p in moved:
                        leave(p)
                    new = g + size[g]
                    for p in moved:
                        group[p] = new
                    size[new] = len(moved)
        end = start
    return group, previous, size
