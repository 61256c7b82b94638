"""A minimal acyclic transducer over sorted byte strings: it maps each string to its place in the order.

It is built from the strings in order, one at a time: only the path of the last
string is open, and what the next string leaves is closed from its end, each
state being replaced by an equal one if there is one.  Every arc carries a
number, and the numbers along a string's path add up to its ordinal.
"""

from __future__ import annotations

import numpy as np

#: Byte classes are numbered from 1; class 0 is any byte that no string has.
_DEAD = 0


class Transducer:
    """Arcs as one dense table: at ``state * classes + class``, the next state (upper 32 bits) and the arc's number.

    State 0 is dead, state 1 the start; the last class stands for a string's end."""

    def __init__(self, table: np.ndarray, classes: np.ndarray, width: int, longest: int, size: int):
        self.table, self.classes, self.width, self.longest, self.size = table, classes, width, longest, size

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the strings ``data[starts:ends]`` are in the vocabulary (their places), and their ordinals.

        All strings are read at once, a byte of each at a time; those that leave the vocabulary are dropped."""
        which = np.flatnonzero(ends - starts <= self.longest)
        at, end = starts[which], ends[which]
        row = np.full(len(which), self.width, np.int64)          # the start's row
        ordinal = np.zeros(len(which), np.int64)
        found, numbers = [], []
        last = self.width - 1
        while len(which):
            done = at == end
            if done.any():
                arc = self.table[row[done] + last]
                known = arc != _DEAD
                found.append(which[done][known])
                numbers.append(ordinal[done][known] + (arc[known] & 0xFFFFFFFF))
                keep = ~done
                which, at, end, row, ordinal = which[keep], at[keep], end[keep], row[keep], ordinal[keep]
                if not len(which):
                    break
            arc = self.table[row + self.classes[data[at]]]
            alive = arc != _DEAD
            if not alive.all():
                which, at, end, ordinal, arc = which[alive], at[alive], end[alive], ordinal[alive], arc[alive]
            ordinal = ordinal + (arc & 0xFFFFFFFF)
            row = (arc >> 32) * self.width
            at = at + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(numbers)


def build(terms: list[bytes]) -> dict:
    """The transducer of sorted, different strings, as arrays: arcs (state, byte, next, number), final states.

    A state's count is the number of strings from it; an arc's number is what comes before it in its state."""
    register: dict[tuple, int] = {}
    counts = [0, 0]                           # of states 0 (dead) and 1 (the start, closed last)
    arcs: dict[int, tuple] = {}

    def close(final: bool, children: list[tuple[int, int]]) -> int:
        key = (final, *children)
        state = register.get(key)
        if state is None:
            state = register[key] = len(counts)
            counts.append(int(final) + sum(counts[c] for _, c in children))
            arcs[state] = key
        return state

    # The open path: for each depth, whether a string ends there, the closed arcs, and the open byte.
    finals, children, path = [False], [[]], b""

    def shorten(depth: int) -> None:
        nonlocal path
        while len(path) > depth:
            state = close(finals.pop(), children.pop())
            children[-1].append((path[-1], state))
            path = path[:-1]

    for term in terms:
        common = 0
        for a, b in zip(path, term):
            if a != b:
                break
            common += 1
        shorten(common)
        for _ in term[common:]:
            finals.append(False)
            children.append([])
        path = term
        finals[-1] = True
    shorten(0)
    arcs[1] = (finals[0], *children[0])
    rows, ends = [], []
    for state, (final, *out) in arcs.items():
        before = int(final)
        if final:
            ends.append(state)
        for byte, child in out:
            rows.append((state, byte, child, before))
            before += counts[child]
    return {"arcs": np.array(rows, np.int32).reshape(-1, 4).tobytes(), "ends": np.array(ends, np.int32).tobytes(),
            "states": len(counts), "width": len({r[1] for r in rows}) + 2, "longest": max(map(len, terms), default=0), "size": len(terms)}


def load(built: dict) -> Transducer:
    """The dense table of a built transducer."""
    arcs = np.frombuffer(built["arcs"], np.int32).reshape(-1, 4).astype(np.int64)
    used = np.unique(arcs[:, 1])
    classes = np.zeros(256, np.int64)
    classes[used] = np.arange(1, len(used) + 1)
    width = len(used) + 2
    table = np.zeros(built["states"] * width, np.int64)
    table[arcs[:, 0] * width + classes[arcs[:, 1]]] = arcs[:, 2] << 32 | arcs[:, 3]
    # A string's end is an arc to a state of no use; its number is 0, as the end comes first in the order.
    table[np.frombuffer(built["ends"], np.int32).astype(np.int64) * width + width - 1] = 1 << 32
    return Transducer(table, classes, width, built["longest"], built["size"])
