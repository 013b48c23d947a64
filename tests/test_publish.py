"""A run is published in one step: whatever write fails, readers get one whole run."""

import dataclasses

import pytest
from pyspark.sql import DataFrameWriter

from eligo.config import RunConfig
from eligo.plans.run import run_classification, run_classification_resumable
from eligo.sinks import tables as sinks
from tests.helpers import charge, frame

CFG = RunConfig(id="a", cutoff_date="2020-12-31")


def state(spark, root):
    """Charge ids of features and outcomes, and the drop counts, as a reader finds them."""
    ids = [sorted(r["charge_id"] for r in sinks.read_run(spark, root, t, "a").collect()) for t in ("features", "outcomes")]
    return (*ids, sorted((r["reason"], r["n_charges"]) for r in sinks.read_run(spark, root, "dropped", "a").collect()))


def rows(spark, first, bad):
    return frame(spark, [charge(first + i, i, "2015-01-01") for i in range(4)] + [charge(900 + i, 9, "2015-01-01", disp="Prepaid") for i in range(bad)])


def test_a_failure_between_any_two_writes_leaves_the_earlier_run(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "db")
    run_classification(spark, root, CFG, write_features=True, charges=rows(spark, 1, 1))
    before = state(spark, root)
    assert before == ([1, 2, 3, 4], [1, 2, 3, 4], [("invalid disposition", 1)])
    import eligo.plans.run as run_mod
    other = rows(spark, 11, 2)
    ready = str(tmp_path / "ready")  # the classification itself is not what is tried here
    run_mod.stage_table(other, CFG, True).write.parquet(ready)
    monkeypatch.setattr(run_mod, "stage_table", lambda *a: spark.read.parquet(ready))
    real, writes, fail_at = DataFrameWriter.parquet, [], [None]

    def parquet(self, path, *args, **kw):
        writes.append(path)
        if len(writes) == fail_at[0]:
            raise RuntimeError("lost")
        return real(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    for n in range(1, 20):
        writes.clear()
        fail_at[0] = n
        try:
            run_classification(spark, root, CFG, write_features=True, charges=other)
        except RuntimeError:
            assert state(spark, root) == before, (n, writes)
        else:
            break
    assert n > 5  # two records, the staged rows and three tables
    assert state(spark, root) == ([11, 12, 13, 14], [11, 12, 13, 14], [("invalid disposition", 2)])
    monkeypatch.undo()
    run_classification(spark, root, CFG, charges=rows(spark, 21, 0))
    assert state(spark, root) == ([], [21, 22, 23, 24], [])
    # What no reader can hold is gone: the present attempt and the one before it are left.
    assert len(list((tmp_path / "db" / "outcomes" / "run_id=a").iterdir())) == 2


def test_a_failed_run_is_recorded_and_hides_nothing(spark, tmp_path, monkeypatch):
    import eligo.plans.run as run_mod
    root = str(tmp_path / "db")
    run_classification(spark, root, CFG, charges=rows(spark, 1, 0))
    monkeypatch.setattr(run_mod, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_classification(spark, root, CFG, charges=rows(spark, 11, 0))
    assert [r["status"] for r in sinks.read_run(spark, root, "runs", "a").collect()] == ["Failed"]
    assert state(spark, root)[1] == [1, 2, 3, 4]
    assert sorted(r["charge_id"] for r in sinks.read_table(spark, root, "outcomes").collect()) == [1, 2, 3, 4]


def test_a_reader_that_began_before_a_rerun_still_reads_its_run(spark, tmp_path):
    root = str(tmp_path / "db")
    run_classification(spark, root, CFG, charges=rows(spark, 1, 0))
    held = sinks.read_run(spark, root, "outcomes", "a")
    run_classification(spark, root, CFG, charges=rows(spark, 11, 0))
    assert sorted(r["charge_id"] for r in held.collect()) == [1, 2, 3, 4]
    assert state(spark, root)[1] == [11, 12, 13, 14]


def test_resumable_runs_publish_alike(spark, tmp_path):
    from eligo.operators.clean import to_raw_layout
    from eligo.plans.run import run_ingestion
    root = str(tmp_path / "db")
    run_ingestion(to_raw_layout(rows(spark, 1, 1)), root, as_of="2020-01-01", buckets=2)
    run_classification_resumable(spark, root, CFG, write_features=True)
    assert state(spark, root) == ([1, 2, 3, 4], [1, 2, 3, 4], [("invalid disposition", 1)])
    run_classification(spark, root, dataclasses.replace(CFG, id="b"))
    assert {r["id"]: r["status"] for r in sinks.read_table(spark, root, "runs").collect()} == {"a": "Completed", "b": "Completed"}
    assert not list((tmp_path / "db" / "_staging").iterdir())
