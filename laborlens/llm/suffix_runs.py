"""Front-coded sorted runs of suffixes, and their merge.

A run is a sorted list of byte strings, each stored as the length of the
prefix that it shares with the one before and the rest.  Runs are merged by a
loser tree whose nodes remember how much of the prefix a string shares with
the one that beat it: strings with different such lengths are ordered without
looking at them, and equal lengths are compared from there on, so no known
prefix is read twice.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, given that ``start`` bytes agree."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    differ = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Shared lengths, lengths of rests and the rests of sorted strings."""
    before, lcps, rests = b"", [], []
    for s in strings:
        n = shared(before, s)
        lcps.append(n)
        rests.append(s[n:])
        before = s
    return np.array(lcps, np.uint8), np.array([len(r) for r in rests], np.uint8), b"".join(rests)


def decode(lcps: np.ndarray, sizes: np.ndarray, rests: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    for n, size in zip(lcps.tolist(), sizes.tolist(), strict=True):
        yield n, rests[at:at + size]
        at += size


def merge(runs: Iterable[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """``(shared with the string before, run, string)`` over all runs in
    sorted order.  ``known[i]`` is what run i's string shares with the last
    one put out if it is a leaf's winner, else with the one that beat it;
    -1 for a run that has ended, which loses to all."""
    its = list(runs)
    if not its:
        return
    size = 1 << (len(its) - 1).bit_length() if len(its) > 1 else 1
    text, known = [b""] * size, [-1] * size
    for i, it in enumerate(its):
        if (first := next(it, None)) is not None:
            text[i], known[i] = first[1], 0
    loser = [0] * size

    def duel(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; both known relative to the same string."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        if known[a] < 0:
            return a, b
        n = shared(text[a], text[b], known[a])
        if n == len(text[a]) or n < len(text[b]) and text[a][n] < text[b][n]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    level = list(range(size))
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for k in range(0, len(level), 2):
            won, lost = duel(level[k], level[k + 1])
            loser[node + k // 2] = lost
            up.append(won)
        level = up
    winner = level[0]
    while known[winner] >= 0:
        yield known[winner], winner, text[winner]
        item = next(its[winner], None)
        if item is None:
            known[winner] = -1
        else:
            known[winner] = item[0]
            text[winner] = text[winner][:item[0]] + item[1]
        node = (winner + size) // 2
        while node:
            other = loser[node]
            if known[other] > known[winner]:
                loser[node], winner = winner, other
            elif known[other] == known[winner] and known[winner] >= 0:
                winner, loser[node] = duel(winner, other)
            node //= 2
