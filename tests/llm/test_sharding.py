"""Differencing shards: sums, groups, slots and balance against plain Python."""

import heapq
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import sharding


def _by_hand(sizes, k):
    """Karmarkar-Karp on lists of lists."""
    heap = [(-s, i, [(s, [i])] + [(0, [])] * (k - 1)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    ticket = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, b[::-1])]
        both.sort(key=lambda t: -t[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], ticket, both))
        ticket += 1
    return sorted(s for s, _ in heap[0][2])


@pytest.mark.parametrize("seed, n, k", [(0, 1, 3), (1, 5, 2), (2, 40, 3), (3, 300, 7), (4, 3, 8)])
def test_differencing(seed, n, k):
    sizes = np.sort(np.random.default_rng(seed).integers(1, 1000, n))[::-1]
    partials = np.zeros((n, k), np.int64)
    partials[:, 0] = sizes
    found = sharding.difference(partials)
    assert (np.sort(found, axis=1) == np.arange(k)).all()
    sums = np.bincount(found[:, 0], weights=sizes, minlength=k)
    assert sorted(sums) == _by_hand([int(s) for s in sizes], k)


def _check(frame, rows, shards):
    expected = sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, len((r["text"] or "").encode()) + 16,
         zlib.crc32((r["text"] or "").encode())) for r in frame.collect()
    )
    got = sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows
    )
    assert got == expected
    groups, slots, sums = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        groups[(r["size"], r["text_crc32"])].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        sums[r["shard"]] += r["size"]
    assert all(len(found) == 1 for found in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sums


@pytest.mark.parametrize("node", [4096, 40])
def test_documents(documents, monkeypatch, node):
    monkeypatch.setattr(sharding, "NODE", node)
    sums = _check(documents, sharding.shard(documents, 8).collect(), 8)
    mean = sum(sums.values()) / 8
    assert max(sums.values()) - min(sums.values()) < 0.02 * mean


def test_one_large_group_is_evened_out(spark):
    rows = [(i, "copy of one text " * 30) for i in range(300)]
    rows += [(1000 + i, f"{i} " * (1 + i % 50)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sums = sorted(_check(frame, sharding.shard(frame, 3).collect(), 3).values())
    assert sums[-1] - sums[0] < 64


def test_odd_rows(odd_documents):
    _check(odd_documents, sharding.shard(odd_documents, 5).collect(), 5)


def test_no_documents(documents):
    assert sharding.shard(documents.limit(0), 4).isEmpty()
