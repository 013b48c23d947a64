"""Run configuration parsing."""

import pytest

from eligo.config import RunConfig, load_config


def test_from_mapping_and_file(tmp_path):
    cfg = RunConfig.from_mapping({"run_id": "x", "cutoff_date": "2019-12-31", "covered_sections_a": ["4.1-305"]})
    assert cfg.id == "x" and cfg.covered_sections_a == ("4.1-305",)
    path = tmp_path / "c.yaml"
    path.write_text("run_id: 'abc'\ncutoff_date: '2020-12-31'\nlifetime_rule: false\n")
    loaded = load_config(str(path))
    assert loaded.id == "abc" and loaded.lifetime_rule is False


def test_invalid_values_rejected():
    with pytest.raises(ValueError):
        RunConfig.from_mapping({"unknown_key": 1})
    with pytest.raises(ValueError):
        RunConfig(dialect="d9")
    with pytest.raises(ValueError):
        RunConfig(cutoff_date="not a date")


def test_randomize_resolves_once():
    cfg = RunConfig(id="randomize").resolved()
    assert cfg.id != "randomize" and cfg.resolved().id == cfg.id


def test_shuffle_partition_sizing():
    from eligo.session import shuffle_partitions_for
    assert shuffle_partitions_for(100 * 1024 ** 4) == 409600
    assert shuffle_partitions_for(10) == 8
