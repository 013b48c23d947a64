"""Run-partitioned results: a repeated run id replaces only its own run."""

import dataclasses

import pytest

from eligo.config import RunConfig
from eligo.plans.run import run_classification, run_classification_resumable
from eligo.schemas import FEATURES
from eligo.sinks import tables as sinks
from eligo.sources.fixtures import load_charges
from tests.conftest import SF_SMALL
from tests.helpers import charge, frame


def test_repeated_run_id_replaces(spark, tmp_path):
    root = str(tmp_path / "db")
    sinks.create_tables(spark, root)
    first = frame(spark, [charge(1, 1, "2015-01-01"), charge(2, 2, "2015-01-01")])
    second = frame(spark, [charge(3, 3, "2015-01-01")])
    cfg_a = RunConfig(id="a", cutoff_date="2020-12-31")
    cfg_b = dataclasses.replace(cfg_a, id="b")
    run_classification(spark, root, cfg_a, write_features=True, charges=first)
    run_classification(spark, root, cfg_b, charges=first)
    run_classification(spark, root, cfg_a, write_features=True, charges=second)
    a = sinks.read_run(spark, root, "outcomes", "a").collect()
    b = sinks.read_run(spark, root, "outcomes", "b").collect()
    assert sorted(r["charge_id"] for r in a) == [3]
    assert sorted(r["charge_id"] for r in b) == [1, 2]
    assert [r["charge_id"] for r in sinks.read_run(spark, root, "features", "a").collect()] == [3]
    runs = {r["id"]: r["status"] for r in sinks.read_table(spark, root, "runs").collect()}
    assert runs == {"a": "Completed", "b": "Completed"}


def test_full_refresh_and_append(spark, tmp_path):
    from eligo.operators.clean import to_raw_layout
    from eligo.plans.run import run_ingestion
    root = str(tmp_path / "db")
    raw = to_raw_layout(frame(spark, [charge(1, 1, "2015-01-01"), charge(2, 1, "2016-01-01")]))
    run_ingestion(raw, root, as_of="2020-01-01")
    run_ingestion(raw, root, as_of="2020-01-01", clear_existing=False)
    assert spark.read.parquet(f"{root}/charges").count() == 4
    run_ingestion(raw, root, as_of="2020-01-01")
    assert spark.read.parquet(f"{root}/charges").count() == 2


def test_person_clustered_write(spark, tmp_path):
    path = str(tmp_path / "persons")
    sinks.write_person_clustered(frame(spark, [charge(1, 1234567, "2015-01-01"), charge(2, 1234999, "2015-01-01")]),
                                 path)
    df = spark.read.parquet(path)
    assert {r["person_prefix"] for r in df.collect()} == {12345, 12349}


def test_write_decision_table(spark, tmp_path):
    path = str(tmp_path / "training_set")
    sinks.write_decision_table(spark, path, fmt="csv")
    df = spark.read.option("header", True).csv(path)
    assert df.count() == 12288 and len(df.columns) == 13


def test_rerun_with_no_rows_empties_the_run(spark, tmp_path):
    root = str(tmp_path / "db")
    cfg = RunConfig(id="42", cutoff_date="2020-12-31")
    run_classification(spark, root, cfg, write_features=True,
                       charges=frame(spark, [charge(1, 1, "2015-01-01")]))
    run_classification(spark, root, cfg, charges=frame(spark, [charge(2, 1, "2030-01-01")]))  # after cutoff
    assert sinks.read_run(spark, root, "outcomes", "42").count() == 0
    assert sinks.read_run(spark, root, "features", "42").count() == 0
    assert [r["status"] for r in sinks.read_run(spark, root, "runs", "42").collect()] == ["Completed"]


def test_classify_table_create_then_append(spark, tmp_path):
    from eligo.plans.run import classify_table
    src = str(tmp_path / "in")
    frame(spark, [charge(1, 1, "2015-01-01", disp="Dismissed"), charge(2, 1, "2016-01-01")]).write.parquet(src)
    out = str(tmp_path / "out")
    classify_table(spark, src, out)
    classify_table(spark, src, out)
    df = spark.read.parquet(out)
    assert df.count() == 4 and len(df.columns) == 28


def _load(spark, root, rows, buckets=None, **kw):
    from eligo.operators.clean import to_raw_layout
    from eligo.plans.run import run_ingestion
    run_ingestion(to_raw_layout(rows), root, as_of="2020-01-01", buckets=buckets, **kw)


def _outcomes(spark, root, run_id):
    return sorted((r["charge_id"], r["expungability"]) for r in sinks.read_run(spark, root, "outcomes", run_id).collect())


@pytest.mark.parametrize("buckets,mode", [(None, "static"), (4, "dynamic")])
def test_refresh_leaves_the_new_rows_alone(spark, tmp_path, buckets, mode):
    root = str(tmp_path / "db")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        _load(spark, root, frame(spark, [charge(i, i, "2015-01-01") for i in range(40)]), buckets)
        run_classification(spark, root, RunConfig(id="a", cutoff_date="2020-12-31"), write_features=True)
        assert sinks.read_run(spark, root, "outcomes", "a").count() == 40
        _load(spark, root, frame(spark, [charge(99, 7, "2015-01-01")]), buckets)
        assert [r["id"] for r in spark.read.parquet(f"{root}/charges").collect()] == [99]
        for table in ("outcomes", "features", "runs", "dropped"):
            assert sinks.read_table(spark, root, table).count() == 0, table
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_append_keeps_the_bucket_layout(spark, tmp_path):
    root, rows = str(tmp_path / "db"), frame(spark, [charge(1, 1, "2015-01-01")])
    _load(spark, root, rows, 4)
    for other in (None, 2):
        with pytest.raises(ValueError, match="buckets"):
            _load(spark, root, rows, other, clear_existing=False)
    _load(spark, root, rows, 4, clear_existing=False)
    assert spark.read.parquet(f"{root}/charges").count() == 2
    with pytest.raises(ValueError, match="4 person buckets"):
        run_classification_resumable(spark, root, buckets=2)


def test_resumable_run_equals_single_run_also_after_changes(spark, tmp_path):
    root, cfg = str(tmp_path / "db"), RunConfig(id="whole", cutoff_date="2019-12-31")
    part = dataclasses.replace(cfg, id="parts")
    all_rows = load_charges(spark, SF_SMALL)
    _load(spark, root, all_rows, 4)
    run_classification(spark, root, cfg)
    run_classification_resumable(spark, root, part)
    assert _outcomes(spark, root, "parts") == _outcomes(spark, root, "whole") != []
    # The same run id with other charges, then with other rules: published anew, nothing of before.
    half = str(tmp_path / "half")
    all_rows.filter("id % 2 = 0").write.parquet(half)
    _load(spark, root, spark.read.parquet(half), 4)
    for change in ({}, {"sameday_rule": False, "lifetime_rule": False}):
        run_classification(spark, root, dataclasses.replace(cfg, **change))
        run_classification_resumable(spark, root, dataclasses.replace(part, **change), write_features=bool(change))
        assert _outcomes(spark, root, "parts") == _outcomes(spark, root, "whole") != []
    assert sinks.read_run(spark, root, "features", "parts").count() == len(_outcomes(spark, root, "parts"))


def test_resume_after_failure_skips_finished_buckets(spark, tmp_path, monkeypatch):
    import eligo.plans.run as run_mod
    root, cfg = str(tmp_path / "db"), RunConfig(id="r", cutoff_date="2019-12-31")
    _load(spark, root, load_charges(spark, SF_SMALL), 4)
    real, calls = run_mod.stage_table, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        return real(*args)

    monkeypatch.setattr(run_mod, "stage_table", failing)
    with pytest.raises(RuntimeError):
        run_classification_resumable(spark, root, cfg)
    run_classification_resumable(spark, root, cfg)
    assert len(calls) == 3 + 2  # buckets 0 and 1 were staged before
    run_classification(spark, root, dataclasses.replace(cfg, id="whole"))
    assert _outcomes(spark, root, "r") == _outcomes(spark, root, "whole") != []


def test_features_and_outcomes_come_from_one_classification(spark, tmp_path, monkeypatch):
    import eligo.plans.classify as classify_mod
    import eligo.plans.run as run_mod
    calls, real = [], classify_mod.classify_rows
    for mod in (classify_mod, run_mod):
        monkeypatch.setattr(mod, "classify_rows", lambda *a, **k: calls.append(1) or real(*a, **k))
    root = str(tmp_path / "db")
    rows = frame(spark, [charge(1, 1, "2015-01-01"), charge(2, 1, "2016-01-01", disp="Prepaid")])
    run_classification(spark, root, RunConfig(id="a", cutoff_date="2020-12-31"), write_features=True, charges=rows)
    assert len(calls) == 1
    assert set(sinks.read_run(spark, root, "features", "a").columns) == {f.name for f in FEATURES.fields}
    dropped = {r["reason"]: r["n_charges"] for r in sinks.read_run(spark, root, "dropped", "a").collect()}
    assert dropped == {"invalid disposition": 1}


def test_run_ids_and_the_full_record(spark, tmp_path):
    for bad in ("2024/a b", "a=b", "", "..", "%41"):
        with pytest.raises(ValueError, match="run id"):
            RunConfig(id=bad)
    root, cfg = str(tmp_path / "db"), RunConfig(id="2024-01.a_B", dialect="d2", apply_cutoff=False, lifetime_limit=3)
    run_classification(spark, root, cfg, charges=frame(spark, [charge(1, 1, "2015-01-01")]))
    assert sinks.read_run(spark, root, "outcomes", cfg.id).count() == 1
    row = sinks.read_run(spark, root, "runs", cfg.id).first()
    again = RunConfig.from_mapping({k: v for k, v in row.asDict().items() if k not in ("start_at", "end_at", "status")})
    assert again == cfg
