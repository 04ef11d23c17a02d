"""Sorted runs of byte strings: common prefixes, front coding, loser trees.

Plain per-task helpers. A run is a sorted list of keys; an entry of a coded
run holds the length of the prefix it shares with the entry before it and the
rest. Merging keeps, for each run's head, the prefix it is known to share with
the last string put out, and compares from there on only.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

HEAD = struct.Struct("<HHHI")


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``start`` bytes are known."""
    i, step, n = start, 16, min(len(a), len(b))
    while i < n and a[i:i + step] == b[i:i + step]:
        i += step
        step *= 2
    while step > 1:
        step //= 2
        if a[i:i + step] == b[i:i + step]:
            i += step
    if i < n and a[i] == b[i]:
        i += 1
    return min(i, n)


def front_coded(entries: Iterable[tuple[bytes, bytes, int]]) -> bytes:
    """Sorted (key, left, count) entries, each key as what differs from the last."""
    out, last = [], b""
    for key, left, count in entries:
        same = common(last, key)
        out += [HEAD.pack(same, len(key) - same, len(left), count), key[same:], left]
        last = key
    return b"".join(out)


def decoded(block: bytes) -> Iterator[tuple[bytes, int, bytes, int]]:
    """(key, prefix shared with the entry before, left, count) in order."""
    i, key = 0, b""
    while i < len(block):
        same, rest, lefts, count = HEAD.unpack_from(block, i)
        i += HEAD.size
        key = key[:same] + block[i:i + rest]
        i += rest
        yield key, same, block[i:i + lefts], count
        i += lefts


def merged(runs: list[Iterator[tuple[bytes, int, bytes, int]]]) -> Iterator[tuple[bytes, int, bytes, int]]:
    """One sorted sequence of all runs by a loser tree; the second figure of each
    entry is the prefix it shares with the entry before it in the whole."""
    width = 1 << max(0, len(runs) - 1).bit_length()
    heads = [next(r, None) for r in runs] + [None] * (width - len(runs))
    known = [0] * width  # shared with the last string put out
    losers = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads; the loser learns what it shares with the winner."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = heads[a][0], heads[b][0]
        same = common(x, y, known[a])
        if same == len(x) == len(y):  # equal keys go by what is to their left
            a, b = (a, b) if heads[a][2] <= heads[b][2] else (b, a)
            known[b] = same
            return a, b
        if same == len(x) or (same < len(y) and x[same] < y[same]):
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while heads[winner] is not None:
        key, _, left, count = heads[winner]
        yield key, known[winner], left, count
        if winner < len(runs) and (head := next(runs[winner], None)) is not None:
            heads[winner], known[winner] = head, head[1]
        else:
            heads[winner] = None
        node = (winner + width) >> 1
        while node:
            winner, losers[node] = play(losers[node], winner)
            node >>= 1
