"""Personal data: base spans against plain expressions, added spans on texts whose data is known."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import personal as p

# The base expressions, leftmost and without overlaps.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text):
    return [int(c) for c in text if c in "0123456789"]


def passes(kind, span):
    digits = digits_of(span)
    if kind == 1:
        return all(int(part) <= 255 for part in span.split("."))
    if kind == 2:
        odd, even = digits[-1::-2], digits[-2::-2]
        total = sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plain_spans(text):
    return sorted(
        (m.start(), kind, m.end())
        for kind, pattern in enumerate((EMAIL, IP, CARD, PHONE))
        for m in pattern.finditer(text or "")
        if passes(kind, m.group())
    )


def listed(spans):
    return ",".join(f"{p.KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


@given(st.text(alphabet="a@.-+0125 (é\n", max_size=60))
def test_base_spans_equal_the_expressions(text):
    assert p.base_spans(text) == plain_spans(text)


@given(st.lists(st.sampled_from(
    ["a@b.c", "@", "x.y@z", "1.2.3.4", ".256.1", "4111111111111111", "4111 1111-1111 1111", " ",
     "+1 (234) 555-0199", "+", "0", "-", "é", "mail at host dot com", "12-34"]), max_size=12))
def test_pieces_put_together(pieces):
    text = "".join(pieces)
    assert p.base_spans(text) == plain_spans(text)
    for start, kind, end in p.candidates(text):
        assert 0 <= start < end <= len(text) and 0 <= kind < len(p.KINDS)
        assert len(p.inputs(text, start, end, kind)) == len(p.INPUTS)


def test_digest_columns(spark, documents):
    rows = {r["doc_id"]: r for r in p.find_personal(documents).collect()}
    for doc_id, text in documents.select("doc_id", "text").collect():
        spans = plain_spans(text)
        row = rows[doc_id]
        for kind, name in enumerate(p.BASE):
            assert row[f"n_{name}"] == sum(s[1] == kind for s in spans)
        assert row["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert set(listed(spans).split(",")) <= set(row["spans"].split(","))


@pytest.fixture(scope="module")
def known_texts(spark):
    """Texts with phones in the base form, with phones in others, and with other numbers."""
    rng = random.Random(3)
    filler = "the of and in to that on with this for at from".split()

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    rows, added = [], {}
    for doc_id in range(1500):
        words = rng.choices(filler, k=30)
        form = doc_id % 5
        a, b, c = number(3), number(3), number(4)
        if form < 2:
            middle = f"call +1 ({a}) {b}-{c} now"
        elif form == 2:
            middle = f"phone ({a}) {b}-{c} today"
        elif form == 3:
            middle = f"total {number(9)} in order {number(8)} ok"
        else:
            middle = "nothing"
        text = f"{' '.join(words[:15])} {middle} {' '.join(words[15:])}"
        if form == 2:
            at = text.index("(")
            added[doc_id] = (at, 3, at + 14)
        rows.append((doc_id, text))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), added


def test_adds_forms_that_no_base_rule_knows(known_texts):
    documents, added = known_texts
    hit = false = 0
    for row in p.find_personal(documents).collect():
        base = listed(plain_spans(dict_of(documents)[row["doc_id"]]))
        more = set(filter(None, row["spans"].split(","))) - set(base.split(","))
        wanted = added.get(row["doc_id"])
        if wanted and listed([wanted]) in more:
            hit += 1
        false += bool(more) and not wanted
    assert hit >= 0.8 * len(added)
    assert false <= 0.02 * 1500


def test_every_example_counts(spark):
    texts = [f"call +1 ({i % 900 + 100}) 555-{i % 9000 + 1000} or total {10**8 + i * 7}"
             for i in range(25_000)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(-1, texts[0])] * 3
    found = p.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    plain = Counter()
    for text in texts:
        plain.update((kind, label, tuple(x)) for kind, label, x in p.propose(text)[2])
    assert sum(plain.values()) > 90_000
    got = Counter()
    for r in p.counted_examples(found).collect():
        got[r["kind"], r["label"], tuple(r["inputs"])] += int(r["n"])
    assert got == plain


_texts = {}


def dict_of(documents):
    if not _texts:
        _texts.update(documents.select("doc_id", "text").collect())
    return _texts


def test_redacted_texts_hold_no_base_span(spark, documents):
    wide = documents.selectExpr("*", "'k' AS found", "'o' AS own_key", "1 AS spans")
    changed = p.redact(wide)
    assert changed.columns == wide.columns and changed.count() == documents.count()
    for row in changed.collect():
        assert not plain_spans(row["text"]) and row["found"] == "k"


def test_odd_rows(spark, odd_documents):
    extra = odd_documents.selectExpr("*", "'x' AS row", "'y' AS base", "'z' AS text_key")
    rows = p.find_personal(extra).collect()
    assert len(rows) == odd_documents.count()
    assert all(r["spans"] == "" and r["n_email"] == 0 for r in rows)
    back = sorted(map(repr, p.redact(extra).collect()))
    assert back == sorted(map(repr, extra.collect()))


def test_repeated_rows_are_searched_each(spark):
    rows = [(1, "mail a.b@example.org")] * 3 + [(None, "ip 1.2.3.4"), (2, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["spans"]) for r in p.find_personal(documents).collect())
    assert found == [(0, "ip:3:10")] + [(1, "email:5:20")] * 3 + [(2, "")]


def test_empty_table(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    assert p.find_personal(documents).collect() == []
    assert p.redact(documents).collect() == []


@pytest.mark.parametrize(
    "unit", ["a", "a.", "1", "1.", "1 ", "@", "a@", "a@b.", "+1 ", "+", "(1) ", " at a dot", "12-3"]
)
def test_hostile_texts_take_linear_time(unit):
    text = unit * (1_000_000 // len(unit))
    begun = time.monotonic()
    p.base_spans(text)
    sum(1 for _ in p.candidates(text))
    assert time.monotonic() - begun < 10
