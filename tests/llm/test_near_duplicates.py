"""Near-duplicate components against all pairs compared exactly."""

import random
import re

import numpy as np
import pytest

from tidemark.llm import components, near_duplicates as nd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    n = nd.SHINGLE
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n, 0) + 1))


def _plain(rows, percent):
    sets = [_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    seen = set()
    for held in holders.values():
        for x in range(len(held)):
            for y in range(x):
                pair = (held[y], held[x])
                if pair in seen:
                    continue
                seen.add(pair)
                a, b = sets[pair[0]], sets[pair[1]]
                if 100 * len(a & b) >= percent * len(a | b):
                    parent[find(pair[1])] = find(pair[0])
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i] and doc_id is not None:
            root = find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(find(i), doc_id) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def _check(frame, percent=85):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    got = sorted(map(tuple, nd.near_duplicates(frame, percent).collect()), key=repr)
    assert got == _plain(rows, percent)
    return got


def _variants(n, edits, length=120, seed=0):
    chance = random.Random(seed)
    base = ["w%d" % chance.randrange(5000) for _ in range(length)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(chance.randrange(edits + 1)):
            words[chance.randrange(length)] = "e%d" % chance.randrange(10**6)
        texts.append(" ".join(words))
    return texts


def test_documents(documents):
    got = _check(documents)
    assert any(not row[3] for row in got)


@pytest.mark.parametrize("size", [512, 16])
def test_a_large_group_of_near_copies(spark, monkeypatch, size):
    monkeypatch.setattr(nd, "SLICE", size)
    texts = _variants(150, 5) + _variants(60, 2, seed=1) + _variants(3, 0, seed=2) * 20
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = _check(frame)
    assert len({row[2] for row in got}) < len(got) / 2


def test_hard_rows(spark, odd_documents):
    _check(odd_documents)
    rows = [(9, "A b c D e f"), (8, "a B\tc\nd  e f"), (7, "a b c d"), (6, "A B C D"), (5, "d c b a"),
            (4, "a b c d e"), (None, "a b c d"), (None, "only null"), (3, "é É"), (2, "é é"),
            (1, "a a a a a a a a"), (0, "a a a a a a")]
    frame = spark.createDataFrame([(*r, 0) for r in rows],
                                  "doc_id long, text string, component_id int")
    _check(frame)


def test_no_documents(documents):
    assert nd.near_duplicates(documents.limit(0)).isEmpty()


def test_threshold_is_exact(spark):
    words = ["w%d" % i for i in range(104)]  # 100 shingles
    rows = [(0, " ".join(words))]
    for i, cut in enumerate((14, 15, 16, 17)):
        rows.append((i + 1, " ".join(words[: 104 - cut])))
    frame = spark.createDataFrame(rows[:1] + rows[2:3], "doc_id long, text string")
    assert len({r[2] for r in _check(frame)}) == 1
    frame = spark.createDataFrame(rows[:1] + rows[3:4], "doc_id long, text string")
    assert len({r[2] for r in _check(frame)}) == 2


def test_posterior_bounds():
    for (m, n), (m2, n2) in zip(nd.least_matches(0.85), nd.least_matches(0.85)[1:]):
        assert m < m2 and n <= n2
    draws = np.random.default_rng(1).random((200_000, nd.HASHES)) < 0.85
    alive = np.ones(len(draws), bool)
    for m, n in nd.least_matches(0.85):
        alive &= draws[:, :m].sum(axis=1) >= n
    assert alive.all()


def test_components(spark):
    chance = random.Random(4)
    edges = [(chance.randrange(400), chance.randrange(400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components.connected_components(frame).collect()))
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(label)):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components.connected_components(frame.limit(0)).isEmpty()
