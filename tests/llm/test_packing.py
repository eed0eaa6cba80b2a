"""Packing against the rules of the contract, an exact solver and the tokenizer itself."""

import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from tidemark.llm import packing
from tidemark.llm.tokens import END_ID, vocabulary_path


def _unrolled(plan):
    """sequence -> [(offset, length)]"""
    bins = defaultdict(list)
    for length, _, count, first, each, offset in plan.placements:
        for i in range(count):
            bins[first + i // each].append((offset + i % each * length, length))
    return bins


def _check(counts, plan):
    bins = _unrolled(plan)
    assert Counter(n for b in bins.values() for _, n in b) == +Counter(counts)
    assert sorted(bins) == list(range(plan.n_sequences))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= plan.capacity


def _optimum(items, capacity):
    @lru_cache(maxsize=None)
    def go(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        best, seen = len(left), set()

        def sets(i, room, chosen):
            yield chosen
            for j in range(i, len(rest)):
                if rest[j] <= room:
                    yield from sets(j + 1, room - rest[j], (*chosen, j))

        for chosen in sets(0, capacity - first, ()):
            after = tuple(x for j, x in enumerate(rest) if j not in chosen)
            if after not in seen:
                seen.add(after)
                best = min(best, 1 + go(after))
        return best

    return go(tuple(sorted(items, reverse=True)))


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    random = np.random.default_rng(seed)
    capacity = int(random.integers(8, 30))
    low = int(random.integers(1, max(2, capacity // 3)))
    items = [int(x) for x in random.integers(low, capacity + 1, 9)]
    left, plan = Counter(items), packing.Plan(capacity)
    packing.reduce_instance(left, plan)
    rest = [x for x, n in left.items() for _ in range(n)]
    assert plan.n_sequences + _optimum(rest, capacity) == _optimum(items, capacity)
    whole = packing.plan_packing(Counter(items), capacity)
    _check(Counter(items), whole)
    assert whole.n_sequences <= _optimum(items, capacity) * 11 / 9 + 1


def test_large_counts_need_few_placements():
    random = np.random.default_rng(0)
    counts = {n: int(random.integers(0, 10**9)) for n in range(1, 4097)}
    plan = packing.plan_packing(counts)
    total = sum(n * c for n, c in counts.items())
    assert len(plan.placements) < 10 * 4096
    assert plan.n_sequences <= total / 4096 * 1.01
    placed = Counter()
    for length, first, count, *_ in plan.placements:
        assert first == placed[length]
        placed[length] += count
    assert placed == +Counter(counts)


@pytest.mark.parametrize("which, capacity", [("documents", 4096), ("odd_documents", 64)])
def test_pieces_and_sequences(request, which, capacity):
    from tokenizers import Tokenizer

    frame = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(vocabulary_path())
    packed = packing.pack(frame, capacity, with_ids=True).cache()
    rows = packed.collect()
    expected = Counter()
    for row in frame.collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [END_ID]
        for i in range(0, len(ids), capacity):
            part = ids[i : i + capacity]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected[(row["doc_id"], i // capacity, i, len(part), crc)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    bins = defaultdict(list)
    for row in rows:
        bins[row["sequence_id"]].append((row["offset"], row["length"], row["ids"]))
    built = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for name, pieces in bins.items():
        at = 0
        for offset, length, ids in sorted(pieces):
            assert offset == at and built[name][offset : offset + length] == ids
            at += length
        assert at <= capacity
    assert len(bins) <= -(-sum(r["length"] for r in rows) // capacity) * 1.05 + 1


def test_ids_pass_through_no_python_once_encoded(documents, plan):
    packed = packing.pack(documents, with_ids=True)
    assert "Join" in plan(packed) and "InArrow" not in plan(packed)


def test_ids_leave_the_encoder_a_slice_of_text_at_a_time():
    import pyarrow as pa

    from tidemark.llm.arrays import in_slices

    texts = ["a" * 600, None, "", "b" * 500, "c" * 2500, "d"] * 3
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(18)), "text": texts})
    parts = list(in_slices([batch, batch.slice(0, 0)], "text", 1000))
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch])
    for part in parts:
        sizes = [len(text or "") for text in part.column("text").to_pylist()]
        assert sum(sizes) <= 1000 or len(sizes) == 1


def test_no_documents(documents):
    assert packing.pack(documents.limit(0)).isEmpty()
