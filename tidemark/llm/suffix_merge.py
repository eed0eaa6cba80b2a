"""Sorted runs of suffixes: front-coded blocks, and their merge by a loser tree that knows prefixes.

A block holds strings in order, each as the length of the prefix it shares with the one before and
the rest. The merge keeps with every loser how long a prefix it shares with the winner it lost to.
Of two strings measured against the same winner the one with the longer shared prefix is smaller;
only where both lengths are equal are characters compared, and only those behind that prefix.
"""

from __future__ import annotations

import pickle

import numpy as np
import zstandard


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, given that ``known`` characters agree."""
    n = min(len(a), len(b))
    step = 32
    while known < n:
        end = min(known + step, n)
        x, y = a[known:end], b[known:end]
        if x != y:
            size = end - known
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return known + (8 * size - differ.bit_length()) // 8
        known, step = end, 2 * step
    return n


def pack_run(strings: list[bytes], fields: dict[str, np.ndarray]) -> bytes:
    """A block of sorted strings and fields of theirs."""
    shared = [0] + [shared_prefix(a, b) for a, b in zip(strings, strings[1:])]
    lengths = np.array([len(s) for s in strings], np.uint32)
    rest = b"".join(s[n:] for s, n in zip(strings, shared))
    body = pickle.dumps((np.array(shared, np.uint32), lengths, rest, fields), protocol=5)
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack_run(block: bytes) -> tuple[list[bytes], list[int], dict[str, np.ndarray]]:
    shared, lengths, rest, fields = pickle.loads(zstandard.ZstdDecompressor().decompress(block))
    strings, at, last = [], 0, b""
    shared = shared.tolist()
    for n, length in zip(shared, lengths.tolist()):
        last = last[:n] + rest[at : at + length - n]
        at += length - n
        strings.append(last)
    return strings, shared, fields


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Run, place within the run and shared prefix with the string before, in merged order."""
    size = 1
    while size < len(runs):
        size *= 2
    strings = [run[0] for run in runs] + [[] for _ in range(size - len(runs))]
    shared = [run[1] for run in runs] + [[] for _ in range(size - len(runs))]
    place = [0] * size
    # Shared prefix with the last winner; -1 for a run that is used up.
    prefix = [0 if s else -1 for s in strings]
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; sets the loser's prefix to what it shares with the winner."""
        x, y = prefix[a], prefix[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        one, other = strings[a][place[a]], strings[b][place[b]]
        n = shared_prefix(one, other, x)
        if one[n : n + 1] <= other[n : n + 1]:
            prefix[b] = n
            return a, b
        prefix[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    out_run, out_place, out_shared = [], [], []
    while prefix[winner] >= 0:
        at = place[winner]
        out_run.append(winner)
        out_place.append(at)
        out_shared.append(prefix[winner])
        at += 1
        place[winner] = at
        prefix[winner] = shared[winner][at] if at < len(strings[winner]) else -1
        node = (winner + size) >> 1
        while node:
            other = loser[node]
            x, y = prefix[winner], prefix[other]
            if x < y:
                winner, loser[node] = other, winner
            elif x == y and x >= 0:
                winner, loser[node] = play(winner, other)
            node >>= 1
    return out_run, out_place, out_shared
