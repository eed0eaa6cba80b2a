"""Ranked search against a plain scorer, for any block size and on odd rows."""

import math
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import lexical

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms_of(text):
    return TERM.findall((text or "").translate(FOLD))


def plain_search(documents, items, top):
    docs = [(doc_id, terms_of(text)) for doc_id, text in documents]
    n_docs = sum(bool(words) for _, words in docs)
    total = sum(len(words) for _, words in docs)
    df = Counter(term for _, words in docs for term in set(words))
    by_item = defaultdict(set)
    for item_id, text in items:
        by_item[item_id] |= set(terms_of(text))
    rows = []
    for item_id, wanted in by_item.items():
        scored = []
        for doc_id, words in docs:
            tf = Counter(words)
            score = 0
            for term in wanted & set(tf):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 100 - 50 + 50 * len(words) * n_docs // total
                score += weight * (10**9 * tf[term] // (1000 * tf[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, lost, doc_id) in enumerate(sorted(scored)[:top], 1):
            rows.append((item_id, rank, None if lost else doc_id, -score))
    return sorted(rows, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block_docs, bundle", [(8192, 128), (37, 5)])
def test_equals_the_plain_scorer(spark, documents, monkeypatch, block_docs, bundle):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(lexical, "BUNDLE", bundle)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    expected = plain_search(documents.select("doc_id", "text").collect(),
                            items.select("item_id", "text").collect(), 7)
    assert found(lexical.search(documents, items, top=7)) == expected


def test_many_equal_documents_are_ranked_by_id(spark):
    docs = [(i, "a rare phrase stands here") for i in range(300, 0, -1)] + [(0, "nothing")]
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, "rare phrase")], "item_id long, text string")
    rows = found(lexical.search(documents, items, top=50))
    assert sorted((r[1], r[2]) for r in rows) == [(i, i) for i in range(1, 51)]


def test_odd_rows(spark, odd_documents):
    items = spark.createDataFrame(
        [(1, "same WORDS"), (1, "é ñ"), (2, None), (3, "  "), (None, "word id"), (4, "absent")],
        "item_id long, text string",
    ).selectExpr("*", "'x' AS term", "0 AS bundle", "1L AS block")
    expected = plain_search(odd_documents.select("doc_id", "text").collect(),
                            items.select("item_id", "text").collect(), 50)
    assert expected
    clashing = odd_documents.selectExpr("*", "'x' AS term", "2 AS item", "3L AS score")
    assert found(lexical.search(clashing, items)) == expected


@pytest.mark.parametrize("empty", ["documents", "items", "both"])
def test_empty_tables(spark, empty):
    rows = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    if empty in ("documents", "both"):
        rows = rows.limit(0)
    if empty in ("items", "both"):
        items = items.limit(0)
    assert lexical.search(rows, items).collect() == []


def test_accumulators_drop_only_what_cannot_be_chosen(spark, documents, monkeypatch):
    """With few owners nothing is dropped early; the result stays the same."""
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    pruned = found(lexical.search(documents, items, top=3))
    monkeypatch.setattr(lexical, "OWNERS", ())
    assert found(lexical.search(documents, items, top=3)) == pruned
