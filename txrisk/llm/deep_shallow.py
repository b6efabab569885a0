"""Sorting strings deep-shallow: multikey quicksort to a shallow depth, then blind tries for groups that still tie."""

from __future__ import annotations

#: Bytes that the quicksort compares at a time, and the depth at which it hands a group over.
CHUNK = 8
SHALLOW = 64


def lcp(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    low, high = 0, high - 1
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class _Node:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int):
        self.depth, self.kids = depth, {}


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


def blind_sort(strings: list[bytes], group: list[int]) -> list[int]:
    """The group in order, by a trie whose inner nodes know only the depth at which their strings part.

    A new string goes down by its bytes at those depths alone; one comparison with the leaf found tells where it parts.
    """
    top = _Node(-1)
    top.kids[0] = [group[0]]
    for i in group[1:]:
        s, node = strings[i], top.kids[0]
        while isinstance(node, _Node):
            node = node.kids.get(_byte(s, node.depth)) or next(iter(node.kids.values()))
        other = strings[node[0]]
        parts = lcp(s, other)
        if parts == len(s) == len(other):
            node.append(i)
            continue
        above, key, node = top, 0, top.kids[0]
        while isinstance(node, _Node) and node.depth < parts:
            above, key = node, _byte(s, node.depth)
            node = node.kids[key]
        if isinstance(node, _Node) and node.depth == parts:
            node.kids[_byte(s, parts)] = [i]
        else:
            made = _Node(parts)
            made.kids = {_byte(other, parts): node, _byte(s, parts): [i]}
            above.kids[key] = made
    out: list[int] = []
    stack: list = [top.kids[0]]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack.extend(node.kids[k] for k in sorted(node.kids, reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow_sort(strings: list[bytes]) -> list[int]:
    """The order of the strings; equal ones stand together."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0, False)]
    while stack:
        group, depth, same = stack.pop()
        if len(group) < 2 or same:
            out.extend(group)
        elif depth >= SHALLOW:
            out.extend(blind_sort(strings, group))
        else:
            pivot = strings[group[len(group) // 2]][depth : depth + CHUNK]
            less, equal, more = [], [], []
            for i in group:
                part = strings[i][depth : depth + CHUNK]
                (equal if part == pivot else less if part < pivot else more).append(i)
            stack += [(more, depth, False), (equal, depth + CHUNK, len(pivot) < CHUNK), (less, depth, False)]
    return out
