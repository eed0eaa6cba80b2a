"""Repeated passages against a table of all windows; merged runs against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import repeats, suffix_merge


def _plain(rows):
    w = repeats.WIDTH
    raw = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    count = Counter(t[i : i + w] for _, t in raw for i in range(len(t) - w + 1))
    out = []
    for doc_id, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - w + 1):
            if count[t[i : i + w]] > 1:
                gone[i : i + w] = b"\1" * w
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


def _check(frame):
    got = [(*tuple(r)[:5], bytes(r["kept"])) for r in repeats.remove_repeats(frame).collect()]
    assert sorted(got, key=repr) == _plain([(r["doc_id"], r["text"]) for r in frame.collect()])
    return got


def _texts(seed, alphabet, n=60):
    chance = random.Random(seed)

    def junk(k):
        return "".join(chance.choices(alphabet, k=k))

    passages = [junk(chance.randrange(150, 700)) for _ in range(6)]
    found = []
    for _ in range(n):
        text = junk(chance.randrange(0, 600))
        for _ in range(chance.randrange(3)):
            p = chance.choice(passages)
            a = chance.randrange(len(p) // 2)
            cut = p[a : a + chance.randrange(100, 700)]
            if chance.random() < 0.3:  # one character changed
                i = chance.randrange(len(cut))
                cut = cut[:i] + "#" + cut[i + 1 :]
            text += cut + junk(chance.randrange(0, 300))
        found.append(text)
    return found


@pytest.mark.parametrize("seed, alphabet, parts, bucket_bytes", [
    (1, "abcdefghijklmnopqrstuvwxyz ", 1, 1 << 24), (2, "abcdefgh é", 7, 4096),
    (3, "ab", 3, 1 << 24), (4, "abcdefghijklmnopqrstuvwxyz", 11, 1024),
])
def test_planted_passages(spark, monkeypatch, seed, alphabet, parts, bucket_bytes):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", bucket_bytes)
    rows = list(enumerate(_texts(seed, alphabet)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = _check(frame)
    assert any(r[2] for r in got) and any(not r[2] for r in got)


def test_hard_rows(spark, odd_documents):
    chance = random.Random(9)
    p = "".join(chance.choices("abcdefgh\0", k=900))
    rows = [
        (0, p), (1, p[100:300]), (2, p[100:299]), (3, "x" + p[400:600] + "y"), (4, "z" * 199),
        (5, "z" * 200), (6, "q" * 201), (7, "ab" * 300), (8, p[700:] + p[:100]), (9, None), (10, ""),
        (11, p[250:500] + p[250:500]), (None, p[600:850]), (0, p), (12, "é" * 150),
        (13, "\0" * 250), (14, p[:250] + "\0" + p[250:500]),
    ]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, kept int")
    _check(frame.repartition(5))
    _check(frame.coalesce(1))
    _check(frame.filter("doc_id in (0, 2, 5, 6)"))
    _check(odd_documents)


def test_long_texts_are_taken_in_stretches(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["".join(_texts(5, "abcdefghij ", 30)), *_texts(5, "abcdefghij ", 30)])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    data, offsets = repeats.texts(frame.select("text").toArrow().column(0).combine_chunks())
    whole = repeats.segments(data, offsets)
    monkeypatch.setattr(repeats, "_STRETCH", 1000)

    def windows(found):
        return {(t, s, p) for _, p, a, b, t, _ in zip(*found) for s in range(a, b + 1)}

    assert windows(repeats.segments(data, offsets)) == windows(whole)


def test_given_documents(documents):
    _check(documents)


def test_no_documents(documents):
    assert repeats.remove_repeats(documents.limit(0)).isEmpty()


@pytest.mark.parametrize("seed", range(6))
def test_merge(seed):
    chance = random.Random(seed)
    runs = []
    for _ in range(chance.choice([1, 2, 3, 7, 16])):
        strings = sorted(
            bytes(chance.choices(b"ab\0", k=chance.randrange(0, 90))) for _ in range(chance.randrange(0, 40))
        )
        back = suffix_merge.unpack_run(suffix_merge.pack_run(strings, {"n": np.arange(3)}))
        assert back[0] == strings
        runs.append((back[0], back[1]))
    run, place, shared = suffix_merge.merge_runs(runs)
    merged = [runs[r][0][p] for r, p in zip(run, place)]
    assert merged == sorted(s for strings, _ in runs for s in strings)
    for a, b, n in zip(merged, merged[1:], shared[1:]):
        assert n == suffix_merge.shared_prefix(a, b)
        assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def test_known_prefixes_are_not_compared(monkeypatch):
    compared = []
    plain = suffix_merge.shared_prefix

    def counted(a, b, known=0):
        n = plain(a, b, known)
        compared.append(n - known)
        return n

    strings = [b"x" * 200 + bytes([65 + i % 26, 65 + i // 26]) for i in range(600)]
    strings.sort()
    runs = []
    for i in range(8):
        own = strings[i::8]
        runs.append((own, [0] + [plain(a, b) for a, b in zip(own, own[1:])]))
    monkeypatch.setattr(suffix_merge, "shared_prefix", counted)
    suffix_merge.merge_runs(runs)
    assert sum(compared) < 8 * 202 + 3 * 600


def _line_in_other_texts(n):
    """A line shorter than a window with other text around it, and the same with more in common."""
    chance = random.Random(17)

    def junk(k):
        return "".join(chance.choices("abcdefghijklmnopqrstuvwxyz ", k=k))

    line, before, after = junk(190), junk(8), junk(60)
    rows = [junk(200) + line + junk(200) for _ in range(n)]
    rows += [junk(200) + before + line + junk(200) for _ in range(9)]
    rows += [junk(200) + line + after + junk(chance.randrange(9)) for _ in range(9)]
    return list(enumerate(rows + rows[:3]))


@pytest.mark.parametrize("hot, parts", [(1, 1), (1, 5), (7, 3), (20, 4)])
def test_hot_seeds(spark, odd_documents, hot, parts):
    rows = _line_in_other_texts(40) + list(enumerate(_texts(1, "abcdefgh é")))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    frame = frame.unionByName(odd_documents.drop("part"))
    got = [(*tuple(r)[:5], bytes(r["kept"]))
           for r in repeats.remove_repeats(frame, hot_segments=hot).collect()]
    assert sorted(got, key=repr) == _plain([(r["doc_id"], r["text"]) for r in frame.collect()])


def test_no_task_gathers_a_hot_seed():
    most, buckets = 50, 3
    texts = [text for _, text in _line_in_other_texts(400)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    found = pa.Table.from_batches(repeats._find(iter([batch]))).sort_by("seed").to_batches(97)
    shared = pa.Table.from_batches(repeats._shared_seeds(most)(iter(found)))
    seeds = Counter(t["seed"] for b in found for t in b.to_pylist() if t["kind"] != repeats._SPAN)
    assert max(seeds.values()) > 150
    items = {}
    for row in shared.to_pylist():
        items.setdefault(row["owner"], []).append((row["kind"], row["item"]))
    packed = next(repeats._pack_texts(iter([
        pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})])))
    rows = [(p["owner"], p["packed"], items[p["owner"]]) for p in packed.to_pylist()
            if p["owner"] in items]
    joined = pa.RecordBatch.from_pydict({
        "owner": [r[0] for r in rows], "packed": [r[1] for r in rows],
        "kinds": [[k for k, _ in r[2]] for r in rows], "items": [[i for _, i in r[2]] for r in rows]})
    blocks = pa.Table.from_batches(repeats._to_blocks(buckets)(iter([joined])))
    of_seed = Counter()
    for row in blocks.to_pylist():
        if row["block"] is not None:
            of_seed.update(s[: repeats.SEED] for s in suffix_merge.unpack_run(row["block"])[0])
    assert not of_seed or max(of_seed.values()) <= most
    windows = Counter((r["bucket"], r["window"]) for r in blocks.to_pylist() if r["window"] is not None)
    assert windows and max(windows.values()) <= 2
