"""Directly addressable token files against the tokenizer's own whole-text encoding."""

import zlib

import numpy as np
import pytest

from tidemark.llm import token_store
from tidemark.llm.tokens import END_ID, vocabulary_path


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID]


@pytest.mark.parametrize("high", [1, 200, 256, 49_408, 1 << 20, (1 << 32) - 1])
def test_any_position_is_addressable(high):
    ids = np.random.default_rng(high).integers(0, high + 1, 5000, dtype=np.uint64)
    ids = ids.astype(np.uint32)
    levels = token_store.encode_levels(ids)
    for positions in ([0], [4999, 3, 3, 64, 63], np.random.default_rng(1).permutation(5000)):
        assert (token_store.ids_at(levels, positions) == ids[positions]).all()


def _expected(rows, encode):
    rows = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    start, out = 0, []
    for row in rows:
        ids = encode(row["text"])
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((row["doc_id"], start, len(ids), crc))
        start += len(ids)
    return out


@pytest.mark.parametrize("which", ["documents", "odd_documents"])
def test_round_trip(spark, tmp_path, request, encode, which):
    frame = request.getfixturevalue(which)
    path = str(tmp_path / "tokens")
    token_store.write_tokens(frame, path)
    got = sorted(map(tuple, token_store.document_digests(spark, path).collect()), key=lambda r: r[1])
    expected = _expected(frame.collect(), encode)
    assert got == expected
    stream = [i for row in sorted(
        frame.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    ) for i in encode(row["text"])]
    asked = [0, 1, len(stream) // 2, len(stream) - 1, len(stream) + 5]
    frame = spark.createDataFrame([(p,) for p in asked], "position long")
    found = dict(map(tuple, token_store.tokens_at(spark, path, frame).collect()))
    assert found == {p: stream[p] for p in asked[:-1]}


def test_empty_table(spark, tmp_path, documents):
    path = str(tmp_path / "none")
    token_store.write_tokens(documents.limit(0), path)
    assert token_store.document_digests(spark, path).isEmpty()
