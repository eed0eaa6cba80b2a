"""Restoring obfuscated words against a search of all readings; scores on held-out rows."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import charmodel, toxicity
from tidemark.llm.arrays import texts

PROSE = (
    "the stupid loser is a moron and the worthless clown talks trash like an idiot "
    "some other plain words stand here so that the letters of the language are counted "
)


@pytest.fixture(scope="module")
def model(spark):
    frame = spark.createDataFrame([(i, PROSE) for i in range(50)], "doc_id long, text string")
    return charmodel.costs(charmodel.count_letters(frame))


def test_letter_counts(spark):
    rows = [("ab",), ("Éa b",), (None,), ("",), ("a-b1",), ("wört",)]
    counts = charmodel.count_letters(spark.createDataFrame(rows, "text string"))
    expected = {}
    for words in (["ab"], ["ea", "b"], ["a", "b"], ["wort"]):
        for word in words:
            context = [0, 0, 0]
            for symbol in [*(ord(c) - 96 for c in word), 0]:
                code = ((context[0] * 27 + context[1]) * 27 + context[2]) * 27 + symbol
                expected[code] = expected.get(code, 0) + 1
                context = [*context[1:], symbol]
    assert {int(i): int(counts[i]) for i in np.flatnonzero(counts)} == expected
    chances = np.exp(-charmodel.costs(counts)).reshape(-1, 27).sum(axis=1)
    assert np.allclose(chances, 1, atol=1e-4)


def _cost(model, columns, choice):
    total, at = 0.0, 0
    for column, i in zip([*columns, [((0,), 0.0)]], [*choice, 0]):
        symbols, channel = column[i]
        total += channel
        for s in symbols:
            if s or at:
                total += float(model[at * 27 + s])
            at = (at * 27 + s) % 27**3 if s else 0
    return total


@pytest.mark.parametrize("word, spaced", [
    ("1d10t", False), ("st*p1d", False), ("mooor0n", False), ("l o s e r", True), ("tr4$h", False),
])
def test_the_path_is_the_cheapest_reading(model, word, spaced):
    restorer = charmodel.Restorer(model)
    columns = restorer._lattice(word, spaced)
    cheapest = min(_cost(model, columns, choice)
                   for choice in itertools.product(*[range(len(c)) for c in columns]))
    path = restorer._path(columns)
    reached = [choice for choice in itertools.product(*[range(len(c)) for c in columns])
               if [s for c, i in zip(columns, choice) for s in c[i][0]] + [0] == path]
    assert min(_cost(model, columns, c) for c in reached) == pytest.approx(cheapest)


@pytest.mark.parametrize("written, read", [
    ("you 1d10t!", "you idiot!"), ("$tupid", "stupid"), ("l0ser, yes", "loser, yes"),
    ("s t u p i d", "stupid"), ("m.o.r.o.n", "moron"), ("stuuuupid", "stupid"),
    ("plain words, 12.5% of 300", "plain words, 12.5% of 300"), ("wow!! $5", "wow!! $5"),
])
def test_restored(model, written, read):
    assert charmodel.Restorer(model).text(written)[0] == read


def test_flags_miss_nothing(model, documents):
    restorer = charmodel.Restorer(model)
    rows = [r["text"] for r in documents.collect()] + ["", "a1", "1a", "x" * 9, "a b c d", "é1é"]
    flags = charmodel.may_be_obfuscated(*texts(pa.array(rows)))
    assert all(flags[i] for i, text in enumerate(rows) if restorer.text(text)[1])


ALPHABET = "aZbö1é0@$!|+*_ .-\n“я"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=1, max_size=6))
def test_a_text_is_flagged_and_restored_whatever_stands_beside_it(model, rows):
    restorer = charmodel.Restorer(model)
    flags = charmodel.may_be_obfuscated(*texts(pa.array(rows)))
    alone = [charmodel.may_be_obfuscated(*texts(pa.array([row])))[0] for row in rows]
    assert flags.tolist() == alone
    for row, flag in zip(rows, flags):
        assert flag or restorer.text(row) == (row, 0)


@pytest.mark.parametrize("text", ["i d i ö t", "ö i d i", "“i d i o”", "ab_3", "3__ab", "x a_b-c.d y"])
@pytest.mark.parametrize("other", ["", "a b c d", "x1", "a", "ö"])
def test_hidden_words_with_accents_and_lines(model, text, other):
    for rows in ([text, other], [other, text]):
        flags = charmodel.may_be_obfuscated(*texts(pa.array(rows)))
        assert flags[rows.index(text)]


def test_one_doc_id_on_many_rows_is_one_sample(spark):
    rows = [(7, f"text {i}") for i in range(200)] + [(8, "other"), (None, "none")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0), (None, 1)], "doc_id long, toxic int")
    sample = toxicity.training_sample(documents, labels).collect()
    assert 1 <= len(sample) <= 2 and sample == toxicity.training_sample(
        documents.repartition(7), labels).collect()


def _corpus(spark):
    chance = random.Random(3)
    bad = ["stupid", "loser", "moron", "worthless", "clown", "trash", "idiot"]
    hidden = ["stup1d", "l0ser", "m o r o n", "w0rthle$s", "clooown", "tr4sh", "1d10t"]
    rows, labels = [], []
    for i in range(1500):
        words = ["".join(chance.choices("abcdefghijklmno", k=chance.randint(3, 7)))
                 for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words.insert(chance.randrange(60), chance.choice(hidden if i % 10 else bad))
        rows.append((i, " ".join(words), "toxic" if toxic else "fine"))
        labels.append((i, None, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    documents, labels = _corpus(spark)
    rows = toxicity.score(documents, toxicity.fit(documents, labels)).collect()
    assert len(rows) == 1500
    unseen = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in unseen} == {
        i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in unseen)
    assert right / len(unseen) > 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_given_labels(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = toxicity.fit(documents, labels)
    scored = toxicity.score(documents, model).join(labels, "doc_id")
    wrong = scored.filter("toxic is not null and predicted != toxic and held_out").count()
    assert wrong <= 0.03 * scored.filter("held_out").count()
    kept = toxicity.reject_toxic(documents, model)
    assert kept.columns == documents.columns
    assert kept.count() == toxicity.score(documents, model).filter("predicted = 0").count()


def test_odd_rows(spark, odd_documents, documents):
    labels = spark.createDataFrame([(1, None), (5, 1), (6, 0)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0), labels.filter("toxic = 1")):
        rows = toxicity.score(odd_documents, toxicity.fit(odd_documents, given)).collect()
        assert len(rows) == odd_documents.count()
        assert all(0 <= r["score"] <= 1 for r in rows)
    none = documents.limit(0)
    assert toxicity.score(none, toxicity.fit(none, labels)).isEmpty()
