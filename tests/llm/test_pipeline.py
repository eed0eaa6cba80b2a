"""The pipeline's stages: columns, decisions, and the whole run against stage-by-stage checks."""

import random
import tracemalloc

import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import charmodel, near_duplicates, toxicity
from tidemark.llm.tokens import encoder, vocabulary_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output, written in between."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        found[name] = (docs, after)
        docs = after
    return found


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_columns_of_documents_stay(stages):
    for name in ("toxicity", "near_duplicates", "decontamination", "secrets"):
        before, after = stages[name]
        assert after.columns == before.columns
        assert [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES])
def test_texts_pass_to_python_by_few_mb(spark, stage):
    """Also when rows are computed, which is after the stage has returned."""

    def largest(batches):
        yield pa.RecordBatch.from_pydict({"size": [max((b.nbytes for b in batches), default=0)]})

    own = spark.newSession()
    none = own.createDataFrame([], "doc_id long, text string")
    stage(own, none, SF)
    docs = own.range(0, 30, 1, 1).selectExpr("id", "repeat('some words ', 100000) AS text")
    sizes = docs.mapInArrow(largest, "size long").collect()
    assert 0 < sizes[0]["size"] < 8 << 20
    mine = spark.newSession()
    mine.conf.set(corpus_pipeline.BATCH_BYTES, "1m")
    stage(mine, mine.createDataFrame([], "doc_id long, text string"), SF)
    assert mine.conf.get(corpus_pipeline.BATCH_BYTES) == "1m"


def test_filters_only_take_rows(stages):
    for name in ("toxicity", "near_duplicates", "decontamination"):
        before, after = stages[name]
        assert after.exceptAll(before).isEmpty()


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(before, toxicity.fit(before, labels))
    expected = {r["doc_id"] for r in scored.filter("predicted = 0").collect()}
    assert {r["doc_id"] for r in after.collect()} == expected


def test_near_duplicates(stages):
    from test_near_duplicates import _plain

    before, after = stages["near_duplicates"]
    judged = _plain([(r["doc_id"], r["text"]) for r in before.collect()], 80)
    assert {r["doc_id"] for r in after.collect()} == {r[0] for r in judged if r[3]}


def test_decontamination(spark, stages):
    from test_decontamination import _plain

    before, after = stages["decontamination"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    judged = _plain([(r["doc_id"], r["text"]) for r in before.collect()],
                    [(r["item_id"], r["text"]) for r in items.collect()])
    assert {r["doc_id"] for r in after.collect()} == {row[0] for row in judged if not row[-1]}


def test_secrets(stages):
    from test_secrets import _plain_all, _plain_base

    before, after = stages["secrets"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = after.collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert not _plain_base(row["text"])
        if not _plain_all(texts[row["doc_id"]]):
            assert row["text"] == texts[row["doc_id"]]


def test_packing(stages):
    before, after = stages["packing"]
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before.collect()}
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) + 2


def test_run_equals_the_stages(spark, stages):
    def places(frame):
        return sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                      for r in frame.collect())

    assert places(corpus_pipeline.run(spark, SF)) == places(stages["packing"][1])


def _kept(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    got = corpus_pipeline.keep_one_of_each_group(spark, frame, SF)
    assert got.schema == frame.schema
    return sorted(map(tuple, got.collect()), key=repr)


def _words(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_repeated_rows_leave_one(spark):
    a, b = _words("a"), _words("b")
    assert _kept(spark, [(1, a, "x")] * 5 + [(2, a, "x"), (3, b, "y"), (3, b, "y")]) == [
        (1, a, "x"), (3, b, "y")]
    assert _kept(spark, [(1, a, "x"), (1, a, "y")]) in ([(1, a, "x")], [(1, a, "y")])


def test_texts_that_share_an_id_are_judged_each(spark):
    a, b = _words("a"), _words("b")
    # The second row of 2 is a copy of 1's, its first is a document of its own.
    assert _kept(spark, [(1, a, "x"), (2, b, "x"), (2, a, "x"), (3, b, "x")]) == [
        (1, a, "x"), (2, b, "x")]
    # One id leads two groups.
    assert _kept(spark, [(1, a, "x"), (1, b, "x"), (4, a, "x"), (5, b + " end", "x")]) == [
        (1, a, "x"), (1, b, "x")]
    # Near-duplicates under one id.
    assert len(_kept(spark, [(1, a, "x"), (1, a + " end", "x")])) == 1


def test_null_ids_are_judged_each(spark):
    a, b, c = _words("a"), _words("b"), _words("c")
    assert _kept(spark, [(None, a, "x")] * 3 + [(None, b, "x"), (7, b, "x"), (None, c, "x")]) == [
        (7, b, "x"), (None, a, "x"), (None, c, "x")]
    assert len(_kept(spark, [(None, a, "x"), (None, a + " end", "x")])) == 1


def test_blank_texts_stay(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " ", "x"), (None, "", "x"), (4, None, "x")]
    assert _kept(spark, rows + rows[:1]) == sorted(rows, key=repr)


# --- odd and empty tables, and what a run leaves behind ---


def _through(spark, docs, sf_dir, folder):
    """Every stage on what the one before left, written in between."""
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        found[name] = docs = spark.read.parquet(path)
    return found


def test_stages_on_odd_rows(spark, odd_documents, tmp_path):
    clashing = odd_documents.selectExpr(
        "*", "'k' AS key", "0 AS label", "'s' AS source", "1 AS row", "2L AS n_words", "'w' AS words"
    )
    found = _through(spark, clashing, SF, tmp_path)
    rows = {name: frame.collect() for name, frame in found.items()}
    # Nothing here is toxic, contaminated or secret; one row stands twice.
    assert len(rows["toxicity"]) == clashing.count()
    distinct = sorted(map(tuple, clashing.distinct().collect()), key=repr)
    for name in ("near_duplicates", "decontamination", "secrets"):
        assert found[name].columns == clashing.columns
        assert sorted(map(tuple, rows[name]), key=repr) == distinct
    ends = {r["doc_id"]: r["length"] for r in rows["packing"] if r["doc_id"] in (1, 2)}
    assert ends == {1: 1, 2: 1}
    assert sum(r["length"] for r in rows["packing"] if r["doc_id"] == 7) > 40_000
    assert {r["doc_id"] for r in rows["packing"]} == {r["doc_id"] for r in distinct_ids(clashing)}


def distinct_ids(frame):
    return frame.select("doc_id").distinct().collect()


@pytest.fixture
def empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{SF}/{name}.parquet").limit(0)
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_stages_on_empty_tables(spark, empty_tables, tmp_path):
    docs = spark.read.parquet(f"{empty_tables}/documents.parquet")
    found = _through(spark, docs, empty_tables, tmp_path / "stages")
    for name, frame in found.items():
        assert frame.isEmpty()
        if name != "packing":
            assert frame.columns == docs.columns
    assert corpus_pipeline.run(spark, empty_tables).collect() == []


def test_sequences_can_be_built_from_the_result(spark, stages):
    import zlib

    import numpy as np

    from tidemark.llm import packing

    _, packed = stages["packing"]
    pieces = packed.collect()
    for r in pieces:
        ids = np.array(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    sequences = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert sum(map(len, sequences.values())) == sum(r["length"] for r in pieces)
    for r in pieces[:200]:
        own = sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert own == r["ids"] and len(sequences[r["sequence_id"]]) <= 4096


def test_a_run_leaves_only_its_result(spark):
    from pathlib import Path

    from tidemark.sources.shared import shared_folder

    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.glob("pipeline-*/*"))
    corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert [p.name for p in set(shared.glob("pipeline-*/*")) - before] == ["packing"]


@pytest.mark.parametrize("work", [
    lambda batch: list(charmodel._count(iter([batch]))),
    lambda batch: list(near_duplicates._sets(iter([batch]))),
    lambda batch: encoder(vocabulary_path()).encode(batch.column("text")),
], ids=["letters", "shingles", "tokens"])
def test_a_batch_takes_little_memory_beside_itself(work):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    work(batch.slice(0, 1))
    tracemalloc.start()
    work(batch)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 25
