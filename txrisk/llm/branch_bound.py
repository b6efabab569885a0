"""Cheapest edits that give a conversation's roles the form ``(s?(ua)+)?``, by depth-first branch and bound.

A row is one character: its role's initial ``s``, ``u``, ``a`` or ``x`` (any other), upper case if its text is truncated, or
``1`` to ``4`` for the same if it must be deleted. Edits are ``K`` keep (0), ``R`` give the row the role that is due (3), ``D`` delete
(4) and ``I`` insert a row of the role that is due (3); a truncated row that is not deleted costs 3 more.
"""

from __future__ import annotations

from functools import lru_cache

#: What stands before: nothing, ``s``, ``u`` or ``a``.
START, SYSTEM, USER, ASSISTANT = range(4)
#: A conversation may end with nothing or after an assistant.
DONE = (START, ASSISTANT)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: After each state, the states that the role's initial of the next row leads to.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state after a row with the role that is due; it is a user or an assistant.
DUE = (USER, USER, ASSISTANT, USER)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INITIALS = "suax"

#: Rows that one search covers. Longer conversations are solved piece by piece for every pair of states at the ends.
PIECE = 32

Best = tuple[int, str]


def edits(row: str, state: int):
    """``(cost, initial, next state)`` of all edits of a row after ``state``."""
    yield DELETE, "D", state
    if row.isdigit():
        return
    more = TRUNCATED if row.isupper() else 0
    kept = NEXT[state].get(row.lower())
    if kept is not None:
        yield more, "K", kept
    yield REROLE + more, "R", DUE[state]


def _least(rows: str) -> list[int]:
    """For every place, a cost that the rows behind it take at least, whatever the states are."""
    bounds = [0]
    for row in reversed(rows):
        bounds.append(bounds[-1] + min(cost for state in STATES for cost, _, _ in edits(row, state)))
    return bounds[::-1]


@lru_cache(maxsize=1 << 15)
def search(rows: str, start: int, ends: tuple[int, ...]) -> tuple[Best | None, int]:
    """The least ``(cost, audit)`` over all edits of ``rows`` that lead from ``start`` to one of ``ends``, and the nodes expanded.

    A node is a place among the rows and the state there. The stack holds prefixes; the cheapest child is taken first. A prefix
    goes if its cost and the rows' bound exceed the incumbent's, if its audit can only lead to a greater one at
    equal cost, or if the node's dominance table has one that is no worse. Of two audits of equal cost at one node, neither begins
    with the other, as an edit more is an insertion and costs more; so what stands behind never turns their order.
    """
    bound = _least(rows)
    table: dict[tuple[int, int], Best] = {}
    incumbent: Best | None = None
    expanded = 0
    stack: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    while stack:
        cost, audit, at, state = stack.pop()
        if table.get((at, state), (cost + 1,)) < (cost, audit):
            continue  # a better prefix came while this one waited
        if incumbent and (cost + bound[at], audit) > (incumbent[0], incumbent[1][: len(audit)]):
            continue
        expanded += 1
        if at == len(rows) and state in ends and (incumbent is None or (cost, audit) < incumbent):
            incumbent = (cost, audit)
        children = [(cost + INSERT, audit + "I", at, DUE[state])]
        if at < len(rows):
            children += [(cost + more, audit + edit, at + 1, after) for more, edit, after in edits(rows[at], state)]
        for child in sorted(children, key=lambda c: (c[0] + bound[c[2]], c[1]), reverse=True):
            node = (child[2], child[3])
            if node not in table or child[:2] < table[node]:
                table[node] = child[:2]
                stack.append(child)
    return incumbent, expanded


Paths = dict[tuple[int, int], Best]


def paths(rows: str) -> Paths:
    """The least edits of a piece between every pair of states."""
    found = {(a, b): search(rows, a, (b,))[0] for a in STATES for b in STATES}
    return {pair: best for pair, best in found.items() if best is not None}


def joined(left: Paths, right: Paths) -> Paths:
    """The least edits of two pieces, one after the other; associative."""
    found: Paths = {}
    for (a, b), (cost, audit) in left.items():
        for c in STATES:
            if more := right.get((b, c)):
                best = (cost + more[0], audit + more[1])
                if (a, c) not in found or best < found[a, c]:
                    found[a, c] = best
    return found


def whole(found: Paths) -> Best:
    return min(found[START, end] for end in DONE if (START, end) in found)


def solve(rows: str) -> Best:
    """The least ``(cost, audit)`` of a conversation."""
    if len(rows) <= PIECE:
        return search(rows, START, DONE)[0]
    found = paths(rows[:PIECE])
    for i in range(PIECE, len(rows), PIECE):
        found = joined(found, paths(rows[i : i + PIECE]))
    return whole(found)
