"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations as co

FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(rows, top, least, longest, inside=50):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                short = (lang, words[i : i + k])
                if 100 * a >= inside * counts[short]:
                    dropped.add(short)
    found = {}
    for (lang, words), a in candidates.items():
        if (lang, words) in dropped:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((10**6 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1)
    )


def mined(documents, **options):
    return sorted(map(tuple, co.collocations(documents, **options).collect()))


@pytest.fixture
def small_tiles(monkeypatch):
    for name, value in {"RANKED": 64, "TILE": 16, "DENSE": 20, "BUFFER": 500}.items():
        monkeypatch.setattr(co, name, value)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_a_plain_count(spark, documents, longest):
    expected = plain(documents.select("text", "lang").collect(), 2000, 5, longest)
    assert len(expected) > 50
    assert mined(documents, least=5, longest=longest) == expected


def test_small_tiles_and_buffers_change_nothing(documents, small_tiles):
    expected = plain(documents.select("text", "lang").collect(), 2000, 5, 3)
    assert mined(documents, least=5) == expected


def test_a_full_filter_changes_nothing(documents, monkeypatch):
    monkeypatch.setattr(co, "BITS", 1 << 15)
    expected = plain(documents.select("text", "lang").collect(), 100, 4, 3)
    assert mined(documents, least=4, top=100) == expected


def test_tally_counts_every_kind_of_tile(monkeypatch):
    for name, value in {"RANKED": 64, "TILE": 16, "DENSE": 40}.items():
        monkeypatch.setattr(co, name, value)
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 63, 100, dtype=np.uint64))
    ranked = rng.permutation(codes)[:50]
    ranks = np.argsort(ranked).astype(np.int32)
    level = co.Known(np.zeros(1, np.uint8), ranked, ranked[ranks], ranks)
    # Small ranks are frequent, and some codes have no rank.
    pick = np.append(ranked, codes[:30])
    first, second = (pick[np.minimum(rng.geometric(0.06, 5000), 79)] for _ in range(2))
    left, right, counts = co.tally(first, second, level, level)
    assert dict(zip(zip(left, right), counts)) == Counter(zip(first, second))
    assert len(counts) == len(set(zip(left, right)))


def test_odd_rows(spark):
    rows = [("a b, a b. c a b", "en")] * 6 + [
        (None, "en"), ("", None), (" \t\n", "en"), ("A B\x0bb a! a b", None),
        ("x y " * 30_000, "fr"), ("é ñ é ñ", "und"), ("é ñ é ñ", ""),
    ] + [("é ñ é ñ", None)] * 3
    documents = spark.createDataFrame(rows, "text string, lang string").selectExpr(
        "*", "1 AS code", "'w' AS word", "2L AS n", "'p' AS phrase"
    )
    expected = plain(rows, 2000, 3, 3)
    assert {row[0] for row in expected} >= {"en", "fr", "und"}
    assert mined(documents, least=3) == expected


def test_counts_beyond_64_bits_are_exact(spark):
    big = 10**13 + 7
    phrases = [([1], "a", big), ([2], "b", big + 2), ([1, 2], "a b", big - 3)]
    schema = "codes array<long>, phrase string, n long"
    every = spark.createDataFrame(phrases, schema)
    pair = every.filter("size(codes) = 2").selectExpr("'en' AS lang", "phrase", "codes", "n AS a")
    row = co._weakest_cuts(pair, every.select("codes", "n")).first()
    assert row["score"] == 10**6 * (big - 3) ** 2 // (big * (big + 2))


def test_empty_table(spark):
    documents = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(documents).collect() == []
