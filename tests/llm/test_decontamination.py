"""Benchmark passages against a search for every window at every place."""

import hashlib
import re
from collections import Counter

import pytest

from tidemark.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain(documents, items):
    windows = {}
    for item_id, text in items:
        words = _words(text)
        for i in range(max(len(words) - dc.WINDOW, 0) + 1 if words else 0):
            window = tuple(words[i : i + dc.WINDOW])
            windows.setdefault(window, set()).add("" if item_id is None else str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in documents:
        words, hit, held = _words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                names = windows.get(tuple(words[i : i + n]))
                if names:
                    hit |= set(range(i, i + n))
                    held |= names
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(held), digest, bool(hit)))
    return Counter(out)


def _check(documents, items):
    got = Counter(map(tuple, dc.decontaminate(documents, items).collect()))
    assert got == _plain(
        [(r["doc_id"], r["text"]) for r in documents.collect()],
        [(r["item_id"], r["text"]) for r in items.collect()],
    )
    return got


def test_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    got = _check(spark.read.parquet(f"{folder}/documents.parquet"),
                 spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert any(row[-1] for row in got)


TEN = "one two three four five six seven eight nine ten"


def test_hard_rows(spark, odd_documents):
    items = spark.createDataFrame(
        [(1, TEN + " eleven"), (2, "Short item"), (3, "word"), (4, None), (5, "..."),
         (6, TEN), (7, "again and again"), (None, "é ñ"), (9, "same same same same"),
         (10, "word " * 12)],
        "item_id long, text string",
    )
    rows = [
        (1, TEN.upper() + " eleven", 0), (2, "x " + TEN.replace(" ", ", "), 0),
        (3, " ".join(TEN.split()[1:]), 0), (4, "a short ITEM, a short item", 0),
        (5, "same same same same same", 0), (6, "É Ñ é ñ", 0), (7, None, 0), (8, "", 0),
        (9, "ten " + TEN, 0), (9, "ten " + TEN, 0), (None, TEN, 0), (11, "word word", 0),
        (12, ("filler " + TEN + " ") * 300, 0),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_hit int")
    _check(documents, items)
    _check(odd_documents, items)


def test_empty_sides(spark, documents):
    items = spark.createDataFrame([(1, TEN)], "item_id long, text string")
    assert dc.decontaminate(documents.limit(0), items).isEmpty()
    _check(documents, items.limit(0))
    _check(documents.limit(5), items.filter("item_id is null"))


def test_no_python_in_the_plan(spark, plan, documents):
    items = spark.createDataFrame([(1, TEN)], "item_id long, text string")
    text = plan(dc.decontaminate(documents, items))
    assert not re.search("Python|Pandas|Arrow|Cartesian", text)


@pytest.mark.parametrize("width", [1, 2, 3])
def test_shingles(spark, width):
    frame = spark.createDataFrame(
        [(1, ["a", "b", "c", "a"]), (2, ["x"]), (3, [])], "doc_id long, words array<string>"
    )
    rows = dc.shingles(frame, ["doc_id"], width).collect()
    expected = [(1, i) for i in range(5 - width)] + ([(2, 0)] if width == 1 else [])
    assert sorted((r["doc_id"], r["at"]) for r in rows) == expected
