"""Command line and SQL views."""

from eligo.__main__ import main
from eligo.operators.clean import to_raw_layout
from eligo.plans.views import register_views
from eligo.sinks import tables as sinks
from tests.helpers import charge, frame


def test_command_line_ingest_and_classify(spark, tmp_path):
    raw = str(tmp_path / "raw")
    to_raw_layout(frame(spark, [charge(1, 1, "2015-01-01", disp="Dismissed"), charge(2, 2, "2016-01-01")])) \
        .write.parquet(raw)
    root = str(tmp_path / "db")
    cfg = tmp_path / "run.yaml"
    cfg.write_text("run_id: cli\ncutoff_date: '2020-12-31'\n")
    main(["ingest", "--raw", raw, "--root", root, "--as-of", "2020-01-01"])
    main(["classify", "--root", root, "--config", str(cfg), "--write-features"])
    assert sinks.read_run(spark, root, "outcomes", "cli").count() == 2
    assert sinks.read_run(spark, root, "features", "cli").count() == 2


def test_sql_over_views(spark):
    register_views(frame(spark, [charge(1, 1, "2015-01-01", disp="Dismissed"), charge(2, 1, "2015-06-01")]))
    rows = spark.sql("SELECT expungability, count(*) AS n FROM outcomes GROUP BY 1 ORDER BY 1").collect()
    assert sum(r["n"] for r in rows) == 2
    assert spark.sql("SELECT count(*) AS n FROM classified WHERE has_conviction").first()["n"] == 2
