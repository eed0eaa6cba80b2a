"""Results of a run appear together or not at all."""

import pytest

from tidemark.sources.committed import (
    commit_run,
    committed_folder,
    committed_manifest,
    committed_runs,
)


def writer(spark, rows, fail_after=None):
    """Writes two tables; fails after the first or the second, or while they are read back."""

    def write(folder):
        results = {}
        for number, name in enumerate(("first", "second")):
            path = f"{folder}/{name}"
            spark.range(rows).selectExpr("id AS n", "id / 2.0D AS x", "'t' AS text").write.parquet(path)
            results[name] = spark.read.parquet(path)
            if fail_after == number:
                raise RuntimeError("sink failed")
        if fail_after == "reading":
            results["first"] = results["first"].selectExpr("n + CAST(raise_error('unreadable') AS INT) AS n")
        return results

    return write


def current(spark, output):
    return spark.read.parquet(f"{committed_folder(spark, output)}/second").count()


def test_no_run_yet(spark, tmp_path):
    assert committed_runs(spark, str(tmp_path)) == []
    with pytest.raises(FileNotFoundError):
        committed_folder(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        committed_manifest(spark, str(tmp_path))


def test_manifest_tells_rows_and_sums(spark, tmp_path):
    commit_run(spark, str(tmp_path), writer(spark, 10))
    found = {r["name"]: r for r in committed_manifest(spark, str(tmp_path)).collect()}
    assert {name: r["row_count"] for name, r in found.items()} == {"first": 10, "second": 10}
    assert found["first"]["sums"] == {"n": 45.0, "x": 22.5}
    assert current(spark, str(tmp_path)) == 10


@pytest.mark.parametrize("fail_after", [0, 1, "reading"])
def test_a_failed_run_leaves_the_former_results(spark, tmp_path, fail_after):
    output = str(tmp_path)
    commit_run(spark, output, writer(spark, 10))
    before = committed_folder(spark, output)
    with pytest.raises(Exception, match="sink failed|unreadable"):
        commit_run(spark, output, writer(spark, 20, fail_after))
    assert committed_folder(spark, output) == before and current(spark, output) == 10
    assert len(list((tmp_path / "runs").iterdir())) == 1


def test_a_killed_run_leaves_the_former_results(spark, tmp_path):
    """What is left of a process that ended without a word: results, or half a manifest."""
    output = str(tmp_path)
    commit_run(spark, output, writer(spark, 10))
    before = committed_folder(spark, output)
    writer(spark, 20)(f"{output}/runs/99999999T000000.000000-killed")
    (tmp_path / "committed" / "99999999T000000.000000-killed").mkdir()
    (tmp_path / "committed" / "99999999T000000.000000-killed" / "part-0.json").write_text("{")
    assert committed_folder(spark, output) == before and current(spark, output) == 10


def test_a_reader_of_the_former_run_is_not_disturbed(spark, tmp_path):
    output = str(tmp_path)
    commit_run(spark, output, writer(spark, 10))
    former = spark.read.parquet(f"{committed_folder(spark, output)}/first")
    commit_run(spark, output, writer(spark, 20))
    assert former.count() == 10 and current(spark, output) == 20


def test_old_runs_go(spark, tmp_path):
    output = str(tmp_path)
    for rows in (1, 2, 3, 4):
        commit_run(spark, output, writer(spark, rows), keep=2)
    assert len(committed_runs(spark, output)) == 2 == len(list((tmp_path / "runs").iterdir()))
    assert current(spark, output) == 4
    with pytest.raises(ValueError):
        commit_run(spark, output, writer(spark, 1), keep=0)


def test_a_run_without_results(spark, tmp_path):
    assert commit_run(spark, str(tmp_path), lambda folder: {}) == {}
    assert committed_manifest(spark, str(tmp_path)).collect() == []
