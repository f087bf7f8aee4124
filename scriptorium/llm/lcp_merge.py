"""Sorted runs of byte strings, front-coded, and their merge by a loser tree that
knows common prefixes.

A run stores each string as the length it shares with the one before and the
rest.  In the tree a string's shared length with the last winner decides against
another's without looking at a byte, unless both are the same; then comparison
goes on after the known prefix, and never before it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

_head = struct.Struct("<III")


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """The length of the common prefix, of which `start` bytes are known."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    step = 16
    while a[start : start + step] == b[start : start + step]:
        start += step
        step *= 2
    differ = int.from_bytes(a[start : start + step].ljust(step, b"\0")) ^ int.from_bytes(b[start : start + step].ljust(step, b"\0"))
    return min(end, start + step - (differ.bit_length() + 7) // 8)


def front_coded(strings: list[bytes], counts: list[int]) -> bytes:
    """A run of different strings in order, each with a count."""
    out, last = [], b""
    for s, n in zip(strings, counts, strict=True):
        k = shared(last, s)
        out.append(_head.pack(k, len(s) - k, n))
        out.append(s[k:])
        last = s
    return b"".join(out)


def decoded(run: bytes) -> Iterator[tuple[int, bytes, int]]:
    """(length shared with the string before, string, count) of a run."""
    at, last = 0, b""
    while at < len(run):
        k, n, count = _head.unpack_from(run, at)
        at += _head.size
        last = last[:k] + run[at : at + n]
        at += n
        yield k, last, count


def merged(runs: list[bytes]) -> Iterator[tuple[int, int, bytes, int]]:
    """(number of the run, length shared with the string before, string, count) over all
    runs in order; a string of several runs comes once for each, with its full length
    shared from the second on."""
    readers = [decoded(r) for r in runs]
    size = 1
    while size < len(runs):
        size *= 2
    # known[i]: what leaf i's string shares with the last winner; None as string: exhausted
    strings: list[bytes | None] = [None] * size
    known, counts = [0] * size, [0] * size
    for i, reader in enumerate(readers):
        first = next(reader, None)
        if first:
            _, strings[i], counts[i] = first

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner and loser of two leaves; the loser's known length becomes that with the winner."""
        a, b = strings[i], strings[j]
        if b is None:
            return i, j
        if a is None:
            return j, i
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        k = shared(a, b, known[i])
        if k == len(a) or (k < len(b) and a[k] < b[k]):
            known[j] = k
            return i, j
        known[i] = k
        return j, i

    losers = [0] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while (string := strings[winner]) is not None:
        yield winner, known[winner], string, counts[winner]
        following = next(readers[winner], None)
        if following:
            known[winner], strings[winner], counts[winner] = following
        else:
            strings[winner] = None
        node = (winner + size) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
