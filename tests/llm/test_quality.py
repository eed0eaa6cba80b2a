"""Counts against plain Python, the binomial tail against exact fractions, held-out risk."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from tidemark.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            hit |= {i, i + 1, i + 2}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(hit)


HARD = [
    "a b c a b c", "a\nb\n\na\n a\na", "\n\n", "x\r\nx\r\n", "é è é è é è é", "a b a b a",
    "##$ |%\t<\x0b>", "one\x1cword", "w " * 60, "\n".join(["line"] * 70), "end\n",
]


def _check(frame):
    got = quality.count_text(frame).select("doc_id", *quality.COUNTS[:5]).collect()
    expected = [(r["doc_id"], *_counts(r["text"])) for r in frame.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_counts(spark, documents, odd_documents):
    _check(documents)
    _check(odd_documents.withColumnRenamed("part", "lang"))
    rows = [(i, t, "en") for i, t in enumerate(HARD)]
    _check(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


@pytest.mark.parametrize("k, n, p", [(0, 10, 0.1), (3, 40, 0.05), (40, 40, 0.5), (7, 300, 0.02)])
def test_binomial_tail(k, n, p):
    q = Fraction(p)
    exact = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
    assert quality.tail(k, n, p) == pytest.approx(float(exact), rel=1e-9)


def _corpus(spark, n):
    chance = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        bad = chance.random() < 0.2
        words = ["w%d" % chance.randrange(10_000) for _ in range(80)]
        if bad:
            words = [w + "$$" if chance.random() < 0.8 else w for w in words]
        rows.append((i, " ".join(words), ["xx", "yy", None][i % 3], "clash"))
        labels.append((i, 0 if bad else 1, None))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, level string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_rules_catch_bad_and_spare_good(spark):
    documents, labels = _corpus(spark, 3000)
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(documents, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [kept[i] for i in truth if truth[i]]
    assert 1 - sum(good) / len(good) <= quality.RISK
    bad = [kept[i] for i in truth if not truth[i]]
    assert sum(bad) / len(bad) < 0.02


def test_few_labels_reject_nothing(spark):
    documents, labels = _corpus(spark, 300)
    few = labels.filter("doc_id < 60")
    rows = quality.judge(documents, few).collect()
    assert len(rows) == 300 and all(r["kept"] for r in rows)
    assert all(r["kept"] for r in quality.judge(documents, labels.limit(0)).collect())


def test_odd_rows(spark, odd_documents, documents):
    labels = spark.createDataFrame([(1, None), (5, 1), (5, 0)], "doc_id long, quality int")
    frame = odd_documents.withColumnRenamed("part", "lang")
    rows = quality.judge(frame, labels).collect()
    assert len(rows) == frame.count()
    for row in rows:
        failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["base_failed"] == failed and row["kept"] == (not failed)
    assert quality.judge(documents.limit(0), labels).isEmpty()
